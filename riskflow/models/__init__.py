"""Scorers, training and the governance record."""
