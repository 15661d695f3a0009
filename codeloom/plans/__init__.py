"""Composed pipelines built from operators."""
