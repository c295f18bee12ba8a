"""Scans: CSV, Parquet, label text, SAS."""
