"""Incremental runs of the same transformations."""
