"""Column functions: text views, n-grams, string similarity."""
