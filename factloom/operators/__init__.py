"""DataFrame operators and the tables that hold their results."""
