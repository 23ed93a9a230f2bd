"""Structured Streaming front of the staging step."""
