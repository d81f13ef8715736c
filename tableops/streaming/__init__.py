"""Structured Streaming over files: exactly-once ingest, and windows over event time with late rows."""
