"""Readers and writers: CSV, Parquet, JDBC, and the run log of curated snapshots."""
