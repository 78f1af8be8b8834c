"""Structured Streaming: the metrics / detector stream, stateful history, progress rows."""
