"""Column expressions and Arrow functions for text and similarity."""
