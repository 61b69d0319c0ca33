"""Readers and writers: CSV, Parquet, keyed tables and message streams."""
