"""Readers, the processed table, and sinks."""
