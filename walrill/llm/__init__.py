"""Operators for preparing training corpora: extraction, tokens, de-duplication, mixing, search, safety, sharding."""
