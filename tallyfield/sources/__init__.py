"""Readers, parsers, writers and file listings."""
