"""Arrival-driven ingest with Structured Streaming."""
