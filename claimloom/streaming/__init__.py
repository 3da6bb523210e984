"""Structured Streaming jobs (stateless)."""
