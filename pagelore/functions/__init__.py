"""Column -> Column expressions made of Spark's own functions."""
