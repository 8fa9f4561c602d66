"""Composed loads, and the registered queries with their SQL counterparts."""
