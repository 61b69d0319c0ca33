"""Column expressions: time, text, labels and JSON."""
