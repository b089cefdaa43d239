"""Operators for training-data pipelines and their queries. Nothing else in the library imports this package."""
