"""Incremental ingestion and change data capture with Structured Streaming."""
