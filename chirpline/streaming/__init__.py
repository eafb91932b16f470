"""Streaming queries, sinks and their progress."""
