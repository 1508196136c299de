"""Column expressions and distribution helpers."""
