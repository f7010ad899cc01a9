"""Column expressions: text signals, vectors, test statistics."""
