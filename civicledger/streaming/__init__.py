"""Exactly-once incremental loading of landed files with Structured Streaming."""
