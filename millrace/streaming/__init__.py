"""Structured Streaming forms of the ingest and session jobs."""
