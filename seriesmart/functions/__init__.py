"""Column expressions: text, numbers and periods. Each takes and returns Columns."""
