"""Column functions: coercion, geometry, parsing and names."""
