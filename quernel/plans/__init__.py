"""Quernel plans."""
