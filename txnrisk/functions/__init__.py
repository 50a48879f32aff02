"""Column expressions: coercion rules and row-local features."""
