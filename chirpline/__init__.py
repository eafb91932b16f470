"""Tweet sentiment counts on Spark: one set of operators, batch and streaming."""
