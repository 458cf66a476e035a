"""Column -> Column helpers. All are built-in Spark expressions, so they stay
inside whole-stage code generation; none is a Python UDF."""
