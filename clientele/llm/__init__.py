"""Operators for preparing training data: tokens, mixing, near copies, vectors, archives, toxicity, pages."""
