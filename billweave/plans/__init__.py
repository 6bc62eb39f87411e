"""Whole runs, and the checked queries over the given tables."""
