"""Registered queries: each runs the library over the given tables and states the same
result in SQL for checking."""
