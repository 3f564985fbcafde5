"""Structured Streaming feed of raw rows."""
