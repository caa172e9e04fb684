"""Column expressions: typed conversion and derived values."""
