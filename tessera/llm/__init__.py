"""Operators for large text corpora: tokens, near-duplicates, secrets, quality."""
