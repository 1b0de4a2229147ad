"""Structured Streaming runners and stateful processors."""
