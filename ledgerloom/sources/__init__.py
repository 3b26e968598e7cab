"""Readers, writers and the catalog of source tables."""
