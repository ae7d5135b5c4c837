"""Readers and writers: raw files, parquet and catalog tables, relational tables."""
