"""Schemas, XML scans, listings, tab separated files."""
