"""Operators: window metrics, rolling baseline + detector, de-dup, views and sinks."""
