"""Structured Streaming forms of the batch windows."""
