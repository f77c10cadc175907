"""Operators for training-data pipelines: privacy, contamination, URLs, copies, language, tokens, quality."""
