"""Operators of a training-data pipeline: one module for each, their queries in ``queries``."""
