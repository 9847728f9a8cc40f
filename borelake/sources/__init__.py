"""Readers of landed files, the source registry, snapshot tables and sinks."""
