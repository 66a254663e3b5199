"""Readers, writers and batch-published tables."""
