"""Column-expression libraries: geometry, projection, text."""
