"""Operators for preparing training data: dedup, mixing, packing, token files, search, sharding."""
