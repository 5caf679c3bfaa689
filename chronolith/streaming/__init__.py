"""Structured Streaming forms of resampling and deduplication."""
