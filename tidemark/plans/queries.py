"""All registered queries."""

from __future__ import annotations

from . import event_queries, snapshot_queries, stream_queries, type_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
