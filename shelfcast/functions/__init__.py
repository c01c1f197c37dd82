"""Column expressions: dates, prices and numeric post-processing."""
