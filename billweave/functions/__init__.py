"""Column expressions: names, types, periods and keys."""
