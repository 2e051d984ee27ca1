"""Structured Streaming pipeline and its sinks."""
