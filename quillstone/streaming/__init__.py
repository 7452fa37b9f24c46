"""Streams over landed files."""
