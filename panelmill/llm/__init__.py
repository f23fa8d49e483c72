"""Operators of a training-data pipeline over documents and conversations; their named queries are in ``queries``."""
