"""Readers and writers: delimited text, Parquet partitions, list files, JSON, models."""
