"""Scans and sinks (S1-S9): catalog or Parquet reads, partition-limited
windows, overwrite, by-name and idempotent per-run appends."""
