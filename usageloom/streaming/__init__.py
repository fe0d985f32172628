"""Continuous ingestion: windowed counts and rollups, raw events, restartable sinks."""
