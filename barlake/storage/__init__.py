"""Partitioned Parquet tables, written by key."""
