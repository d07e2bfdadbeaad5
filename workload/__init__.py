"""Fixture views over the given tables, and one registered query per operator."""
