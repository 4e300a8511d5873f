"""Structured Streaming forms of the metrics that make sense on live events."""
