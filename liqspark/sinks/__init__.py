"""Batch and streaming sinks: Parquet, CSV, JDBC, console, upsert."""
