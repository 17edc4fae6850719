"""Raqim: a PySpark-native engine for discovering, extracting, classifying and indexing web content."""

__version__ = "0.1.0"
