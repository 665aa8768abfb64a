"""Column expressions built from built-in functions."""
