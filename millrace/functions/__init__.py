"""Column expressions: JSON text, time text and column names."""
