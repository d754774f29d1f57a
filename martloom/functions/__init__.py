"""Column expressions: money, text and names."""
