"""Structured Streaming forms of the recurring flows."""
