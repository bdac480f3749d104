"""Column functions: text, hashing and arrays of probabilities."""
