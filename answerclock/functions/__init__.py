"""Column expressions. All but the stemmer are built-in Spark functions."""
