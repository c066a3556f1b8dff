"""Operators of a training-data pipeline: scoring, deduplication, extraction, mixing and packing."""
