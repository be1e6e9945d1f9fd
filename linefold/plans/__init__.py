"""Composed jobs (``run.run_orders``, D46) and the proofs on the driver's
tables: mapping M, the Spark proof queries and their DuckDB oracles."""
