"""Column functions: text normalisation, similarity, reading of completion replies."""
