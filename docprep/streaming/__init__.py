"""Incremental runs over arriving documents with Structured Streaming."""
