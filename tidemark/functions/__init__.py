"""Column expressions and normalisers."""
