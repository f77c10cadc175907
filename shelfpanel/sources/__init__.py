"""Readers, the marketplace dimension and sinks."""
