"""Column helpers shared by the builders; all are built-in Spark expressions."""
