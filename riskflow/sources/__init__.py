"""Typed scans, in-memory rows and JSON requests."""
