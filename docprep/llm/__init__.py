"""Operators for training data: near-duplicates, broken pairs, look-alike text, splitting, packing, mixing, reading level."""
