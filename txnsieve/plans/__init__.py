"""Whole jobs composed from operators, and the queries over the given tables."""
