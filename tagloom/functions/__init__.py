"""Column expressions: tags, scores, vectors."""
