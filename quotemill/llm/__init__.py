"""Operators that a training-data pipeline needs, each of them DataFrame -> DataFrame."""
