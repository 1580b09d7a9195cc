"""Column expressions (parsing, cleaning) and fixed word lists."""
