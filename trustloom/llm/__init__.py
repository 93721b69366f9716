"""Training-data operators: filtering, deduplication, mixing, sharding, extraction and formatting.

Nothing outside this subpackage imports it.
"""
