"""All queries of this subpackage."""

from __future__ import annotations

from . import native_queries, python_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
