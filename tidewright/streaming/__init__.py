"""Structured Streaming jobs and the keyed serving table."""
