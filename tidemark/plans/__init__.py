"""Composed plans: the capture pipeline and the registered queries."""
