"""Compositions of operators: the consolidation flow, read views and queries."""
