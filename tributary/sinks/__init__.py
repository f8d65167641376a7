"""Outputs: month-partitioned Parquet."""
