"""Column functions: pure expressions, no I/O."""
