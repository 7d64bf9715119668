"""Operators that prepare training text: sharding, de-duplication, mixing, formatting, filters and encodings."""
