"""Column expressions. All are built from Spark's own functions, so they stay in code generation."""
