"""Incremental loading of landed monthly files with Structured Streaming."""
