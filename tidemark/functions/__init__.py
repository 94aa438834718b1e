"""Column functions: every one is a plain Spark expression unless its doc says otherwise."""
