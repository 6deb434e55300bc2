"""Structured Streaming form of the change load."""
