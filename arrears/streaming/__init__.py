"""Structured Streaming form of the insert-only loads."""
