"""Readers: numbers, line documents and points, from text files or tables."""
