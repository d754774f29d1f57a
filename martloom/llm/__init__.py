"""Operators for training-data corpora: text, vectors and conversations."""
