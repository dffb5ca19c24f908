"""Column expressions, fixed texts, p-values and session helpers."""
