"""Scalar functions as columns, and the JSON helpers behind the Arrow functions."""
