"""Whole queries: SQL over the record view, and the registered catalogue."""
