"""Whole jobs: prepare, validate, train, score."""
