"""Operators for training-data pipelines over text, pages, vectors and conversations."""
