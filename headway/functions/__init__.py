"""Column functions; every one returns a Spark ``Column`` built from built-in expressions."""
