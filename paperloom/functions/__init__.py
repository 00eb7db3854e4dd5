"""Column expressions: text cleaning, extraction, normalization, similarity."""
