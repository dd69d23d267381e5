"""Operators put together: the staged pipeline and the registered queries."""
