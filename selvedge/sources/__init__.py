"""Readers: Parquet tables, and vendor feeds as JSON, XML and CSV."""
