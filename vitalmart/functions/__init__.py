"""Column functions: casts, keys, measures and code handling."""
