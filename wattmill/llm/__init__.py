"""Training-data operators: deduplication, filtering, tokenising, sharding and packing.

Nothing outside this subpackage imports it.
"""
