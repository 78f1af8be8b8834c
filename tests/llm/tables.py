"""Folders of the driver's tables."""

TINY = "/root/testdata/sf0.001"
SMALL = "/root/testdata/sf0.01"
