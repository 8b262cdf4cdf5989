"""Quernel sources."""
