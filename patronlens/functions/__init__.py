"""Column-level helpers; everything here is built-in Spark expressions."""
