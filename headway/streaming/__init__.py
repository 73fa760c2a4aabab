"""Incremental scoring of arriving files."""
