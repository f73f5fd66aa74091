"""Column functions that build report text."""
