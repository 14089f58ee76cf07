"""Whole jobs: the change store, the ingest, the driver-table views."""
