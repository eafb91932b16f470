"""Readers and writers: CSV, messages, stored tables."""
