"""Column -> Column helpers built from Spark expressions."""
