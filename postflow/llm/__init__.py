"""Operators for training-data pipelines: one module for each, queries and SQL beside them."""
