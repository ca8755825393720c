"""Column functions: each takes and returns Spark columns, with no job of its own."""
