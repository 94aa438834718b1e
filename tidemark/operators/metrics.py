"""Counters, tags and heartbeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.offsets import format_offsets
from .envelope import CREATED, DELETED, UPDATED


def _counters() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("op") == CREATED).alias("total_creates"),
        F.count_if(F.col("op") == UPDATED).alias("total_updates"),
        F.count_if(F.col("op") == DELETED).alias("total_deletes"),
    ]


def event_counters(df: DataFrame) -> DataFrame:
    """One row: events seen, creates, updates, deletes."""
    return df.agg(*_counters())


def observe_counters(df: DataFrame, observation: Observation | str) -> DataFrame:
    """The same counters as a by-product of whatever job runs the frame, batch or stream."""
    return df.observe(observation, *_counters())


def metric_tags(df: DataFrame, tags: str | None, out: str = "tags") -> DataFrame:
    """Attaches ``k1=v1,k2=v2`` as a map to every metric row."""
    if not tags:
        return df.withColumn(out, F.create_map().cast("map<string,string>"))
    return df.withColumn(out, F.str_to_map(F.lit(tags), F.lit(","), F.lit("=")))


def heartbeats(
    events: DataFrame, interval_ms: int, heartbeat_prefix: str, topic_prefix: str, *, ts_ms: Column | str = "ts_ms"
) -> DataFrame:
    """One progress row per interval of change time: the last vector in it. None when the interval is 0.

    ``events`` carry ``offsets`` and ``seq``. Intervals fold before the shuffle.
    """
    moment = F.col(ts_ms) if isinstance(ts_ms, str) else ts_ms
    topic = F.lit(f"{heartbeat_prefix}.{topic_prefix}").alias("topic")
    if interval_ms <= 0:
        return events.limit(0).select(topic, F.lit(0).cast("bigint").alias("interval_end"), F.lit("").alias("offsets"))
    size = F.lit(interval_ms).cast("bigint")
    end = moment - F.pmod(moment, size) + size
    return (
        events.groupBy(end.alias("interval_end"))
        .agg(F.max_by("offsets", "seq").alias("__last"))
        .select(topic, "interval_end", format_offsets("__last").alias("offsets"))
    )


def snapshot_heartbeat(snapshot_vector: DataFrame, heartbeat_prefix: str, topic_prefix: str) -> DataFrame:
    """The one heartbeat that always follows a snapshot, from its one-row vector."""
    return snapshot_vector.select(
        F.lit(f"{heartbeat_prefix}.{topic_prefix}").alias("topic"), format_offsets("offsets").alias("offsets")
    )
