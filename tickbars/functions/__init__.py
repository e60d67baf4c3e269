"""Column expressions: derived metrics, message parsing, calendar and number helpers."""
