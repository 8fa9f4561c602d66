"""Structured Streaming forms of the file feed and the batch summary."""
