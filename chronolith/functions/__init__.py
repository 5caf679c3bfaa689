"""Column expressions and exact-decimal functions."""
