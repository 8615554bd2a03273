"""Column expressions: geometry, dates, names."""
