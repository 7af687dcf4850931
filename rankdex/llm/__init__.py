"""Operators for training data: URL filters, archives, near duplicates, tokens, quality."""
