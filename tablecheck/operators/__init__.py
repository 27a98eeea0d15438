"""Relational operators on one or two tables."""
