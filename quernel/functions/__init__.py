"""Quernel functions."""
