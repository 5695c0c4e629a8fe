"""Structured Streaming over event files."""
