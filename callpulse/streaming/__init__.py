"""Structured Streaming jobs around the same operators as the tables."""
