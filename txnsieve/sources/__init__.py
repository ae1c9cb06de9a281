"""Readers: stored tables, topics and JSON requests."""
