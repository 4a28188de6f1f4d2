"""Spark operators over bar tables: ordering/chunking, windows, EMA, labels, validation, metrics,
drift, prediction evaluation and the run registry."""
