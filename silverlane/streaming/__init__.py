"""Structured Streaming: landed files into Silver."""
