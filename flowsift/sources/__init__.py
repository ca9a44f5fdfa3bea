"""Readers, writers and views over given tables."""
