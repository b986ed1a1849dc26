"""Named query catalog: each key pairs a Spark builder with an independent DuckDB statement."""
