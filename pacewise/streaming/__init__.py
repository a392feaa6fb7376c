"""Incremental conversion of newly arrived files with Structured Streaming."""
