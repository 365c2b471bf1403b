"""Whole runs, and the queries checked against SQL."""
