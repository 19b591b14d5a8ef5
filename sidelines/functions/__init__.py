"""Column expressions: every one is a built-in Spark expression, none is a Python UDF."""
