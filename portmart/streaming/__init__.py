"""Incremental (monthly) ingestion with Structured Streaming."""
