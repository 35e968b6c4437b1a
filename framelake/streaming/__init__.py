"""Structured Streaming variants of the resource monitor and chunk ingestion."""
