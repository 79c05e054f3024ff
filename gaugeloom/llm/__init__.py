"""Operators for training text: tokens, quality, duplicates, mixing and filters."""
