"""Column expressions: coercion, interval validity, geometry, keys and citations."""
