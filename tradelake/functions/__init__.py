"""Column functions and plain argument rules."""
