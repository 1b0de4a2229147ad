"""Readers: stored tables, text/CSV/JSON files, in-memory rows, message queues."""
