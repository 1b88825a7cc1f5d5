"""Column-level helpers built from Spark functions."""
