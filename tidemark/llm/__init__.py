"""Training-data operators: quality, de-duplication, packing, mixing, extraction, search, archives.

Nothing outside this package imports it; ``queries.queries()`` lists its registered queries.
"""
