"""Column expressions.  All are built-in Spark expressions, so they stay in generated code."""
