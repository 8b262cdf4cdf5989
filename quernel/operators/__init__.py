"""Quernel operators."""
