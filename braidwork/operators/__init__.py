"""Operators on DataFrames: routing, pairing, comparison, attribution, views, reporting and audit."""
