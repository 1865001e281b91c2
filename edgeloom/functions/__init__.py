"""Scalar functions, all native column expressions."""
