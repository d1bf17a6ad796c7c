"""Column expressions the operators are built from."""
