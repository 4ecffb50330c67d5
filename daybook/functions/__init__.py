"""Column expressions: tolerant casts and exact money sums."""
