"""Column expressions: cell ids, distances and projections, tag text, text and number helpers."""
