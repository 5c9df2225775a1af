"""Column expressions: geometry, text, URLs, dates, similarity."""
