"""Schemas and readers."""
