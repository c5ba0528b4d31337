"""Readers, writers and the catalog of input tables."""
