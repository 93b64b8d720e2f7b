"""Operators of a training-data pipeline, their queries and their SQL."""
