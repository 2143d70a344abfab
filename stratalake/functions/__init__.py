"""Column functions. Each returns a Column built from Spark's own functions."""
