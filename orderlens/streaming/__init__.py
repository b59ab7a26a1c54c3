"""Incremental ingest (file-source Structured Streaming) of raw order CSVs."""
