"""Column functions: text clean-up, JSON repair, scores, the recursive splitter."""
