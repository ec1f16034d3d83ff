"""Readers and writers: delimited text, parquet folders, catalog tables."""
