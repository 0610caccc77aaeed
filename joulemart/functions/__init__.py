"""Column expressions: parsing, labels, keys and exact arithmetic."""
