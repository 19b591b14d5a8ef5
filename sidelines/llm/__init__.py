"""Operators for training-data pipelines over texts, pages and conversations."""
