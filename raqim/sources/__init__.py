"""Readers and generators of input tables."""
