"""Readers, writers and the adapter over the order tables."""
