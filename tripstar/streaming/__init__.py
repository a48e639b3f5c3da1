"""Structured Streaming jobs that keep the same tables up to date."""
