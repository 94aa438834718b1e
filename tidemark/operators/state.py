"""Compaction of keyed events to the current state per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .envelope import DELETED


def latest_per_key(events: DataFrame, key: str = "key", order: str | list[str] = "seq") -> DataFrame:
    """The last event of each key, deletes included.

    A key's events fold together before the shuffle, so a key holding most of
    the log costs one row per input split.
    """
    by = [order] if isinstance(order, str) else order
    rank = F.col(by[0]) if len(by) == 1 else F.struct(*by)
    columns = [c for c in events.columns if c != key]
    return (
        events.groupBy(key)
        .agg(F.max_by(F.struct(*columns), rank).alias("__last"))
        .select(key, "__last.*")
    )


def current_state(events: DataFrame, key: str = "key", order: str | list[str] = "seq") -> DataFrame:
    """The newest row of every key that was not deleted last."""
    return latest_per_key(events, key, order).where(F.col("op") != DELETED)
