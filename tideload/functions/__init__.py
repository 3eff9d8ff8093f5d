"""Column helpers: every one returns a built-in expression, none is a UDF."""
