"""Operators for preparing training text, and the queries that apply them to the given tables."""
