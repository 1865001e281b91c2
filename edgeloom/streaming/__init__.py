"""Structured Streaming versions of edge operators."""
