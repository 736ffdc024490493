"""Operators for training-data pipelines: one module per operator, queries in ``queries``."""
