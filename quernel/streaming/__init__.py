"""Quernel streaming."""
