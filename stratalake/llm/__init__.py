"""Operators for large-scale training data. Nothing outside this folder imports it."""
