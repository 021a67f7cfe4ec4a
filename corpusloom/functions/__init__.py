"""Column helpers: Spark expressions without data movement."""
