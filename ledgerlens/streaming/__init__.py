"""Structured Streaming forms of the ingest and of the daily load table."""
