"""Structured Streaming forms of the keyed operators."""
