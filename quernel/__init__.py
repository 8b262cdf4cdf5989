"""Quernel: a PySpark-native engine for curating and measuring text corpora."""

__version__ = "0.1.0"
