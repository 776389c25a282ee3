"""Scans, extracts, sinks and versioned tables."""
