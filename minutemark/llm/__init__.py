"""Operators for preparing training text: dedup, filtering, mixing, sharding and packing."""
