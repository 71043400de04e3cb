"""Schemas, readers, writers, catalog access and the feeds built from the test tables."""
