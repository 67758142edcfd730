"""Incremental ingest: change detection, retries, breakers and keyed merges."""
