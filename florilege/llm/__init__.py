"""Operators for preparing training text: canonical values, near-duplicates, name variants, tokens, packing, shared spans."""
