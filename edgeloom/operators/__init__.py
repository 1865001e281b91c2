"""Operators over registries, edges, templates and curation tables."""
