"""Operators for preparing text corpora: near-duplicates, mixing, search, models, tokens."""
