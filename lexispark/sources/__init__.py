"""Readers, the cleaned-text cache and the sinks."""
