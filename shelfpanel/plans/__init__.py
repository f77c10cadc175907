"""User-level jobs."""
