"""Column helpers and the skew-safe window building blocks."""
