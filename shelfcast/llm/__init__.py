"""Operators for training-data pipelines: near-duplicates, tokens, mixing, classifiers, search."""
