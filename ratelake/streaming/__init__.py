"""Structured Streaming entry points: Bronze ingest, incremental Silver."""
