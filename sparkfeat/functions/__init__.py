"""Column-expression helpers and per-column feature extraction."""
