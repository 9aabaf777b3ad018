"""Composite views and the query registry."""
