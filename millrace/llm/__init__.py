"""Operators of a training-data pipeline; the rest of the package does not import them."""
