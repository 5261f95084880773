"""Structured Streaming forms of the batch pipelines."""
