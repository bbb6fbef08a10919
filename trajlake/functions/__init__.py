"""Column functions: geometry, path metadata, text cells, rounding."""
