"""Structured Streaming forms of ingest, alert suppression and error rates."""
