"""Relational and stateful operators over crawl tables."""
