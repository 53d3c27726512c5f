"""Readers: CSV ingest and Parquet scans (with partition discovery)."""

from facetspark.sources.csv import CSV_OPTIONS, read_csv
from facetspark.sources.parquet import read_parquet, read_table

__all__ = ["CSV_OPTIONS", "read_csv", "read_parquet", "read_table"]
