"""Training-data operators: quality, deduplication, mixing, packing, extraction and archive formats.

Nothing outside this package imports it; its queries are registered in ``queries.py``.
"""
