"""Readers, writers and table access."""
