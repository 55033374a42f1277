"""Operators that prepare training text: near copies, tokens, packing, filters, search, shards."""
