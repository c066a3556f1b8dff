"""End-to-end jobs: ingest, annotate, export, serve."""
