"""Column expressions: every rule is a built-in Spark expression, so it stays in generated code."""
