"""Structured Streaming forms of resume and chain state."""
