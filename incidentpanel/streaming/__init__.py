"""Structured Streaming overlays."""
