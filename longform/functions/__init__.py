"""Column expressions: CSV dialects, header names, values and keys."""
