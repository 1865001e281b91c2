"""Dataflows that put operators together, and the registered queries."""
