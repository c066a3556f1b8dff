"""Incremental file ingest as a file stream."""
