"""Scoring streams of new rows with fitted models."""
