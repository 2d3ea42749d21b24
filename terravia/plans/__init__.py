"""Composite jobs, fixtures over the given tables and the query registry."""
