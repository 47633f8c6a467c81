"""Column expressions: names, sizes, types and schema texts."""
