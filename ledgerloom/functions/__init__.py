"""Column expressions: everything here is built-in functions only."""
