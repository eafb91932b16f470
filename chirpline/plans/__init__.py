"""Whole jobs built from operators, sources and streams."""
