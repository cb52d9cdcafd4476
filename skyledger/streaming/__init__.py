"""Increments that arrive as files."""
