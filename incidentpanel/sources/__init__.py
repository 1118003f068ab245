"""Readers, writers and path handling (all through Spark's own data sources)."""
