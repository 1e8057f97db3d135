"""Operators for large-scale training data; nothing outside this subpackage and ``corpus_pipeline`` imports it."""
