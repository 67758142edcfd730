"""Preparation of training text: counts, body extraction, near-duplicates, encoding, leaks, repetition."""
