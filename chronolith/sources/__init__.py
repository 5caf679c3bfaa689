"""Scans and sinks: text archives, tick adapters, Parquet with exact schemas."""
