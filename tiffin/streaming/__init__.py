"""Continuous file ingest and the incrementally kept daily city table."""
