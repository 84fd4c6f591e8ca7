"""Readers and writers: parquet tables, day shards, CSV with bad lines, load modes."""
