"""Bounded snapshots: which records belong, first marks, progress, notifications, hand-over."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..logschema import BEGIN_SNAPSHOT, COMMIT_SNAPSHOT, SEQ
from .offsets import begin_at, last_vector

# Fixed values of snapshot notifications.
AGGREGATE_TYPE = "Initial Snapshot"
STARTED = "STARTED"
COMPLETED = "COMPLETED"


def snapshot_commits(df: DataFrame, n: int, *, seq: str = SEQ) -> DataFrame:
    """One row ``commits``: the first commit's ``seq`` of each partition 0..n-1, null where there is none."""
    commit = F.col("Type") == COMMIT_SNAPSHOT
    firsts = [F.min(F.when(F.col("PartitionId") == i, F.col(seq))) for i in range(n)]
    return df.where(commit).agg(F.array(*firsts).alias("commits"))


def snapshot_rows(df: DataFrame, n: int, *, seq: str = SEQ) -> DataFrame:
    """Records of the snapshot: markers dropped, and all at or after the partition's first commit.

    Before the commit, any other kind counts as a row. A partition that has not
    committed yet passes whole. The commits are one value of ``n`` numbers,
    found in a first pass over the markers; the records are filtered where they
    lie, without a join.
    """
    own = F.get(snapshot_commits(df, n, seq=seq).scalar(), F.col("PartitionId"))
    data = df.where(~F.col("Type").isin(BEGIN_SNAPSHOT, COMMIT_SNAPSHOT))
    return data.where(own.isNull() | (F.col(seq) < own))


def snapshot_complete(df: DataFrame, n: int) -> DataFrame:
    """One row ``completed``: true when all ``n`` partitions have committed."""
    return snapshot_commits(df, n).select(F.forall("commits", lambda c: c.isNotNull()).alias("completed"))


def mark_first(df: DataFrame, *, seq: str = SEQ, out: str = "snapshot") -> DataFrame:
    """Marks the first snapshot row ``first`` and the others ``true``."""
    first = df.agg(F.min(seq)).scalar()
    return df.withColumn(out, F.when(F.col(seq) == first, "first").otherwise("true"))


def snapshot_flags(snapshot: Column, completed: Column) -> Column:
    """State of a snapshot: ``running`` is snapshot and not completed; ``marker`` is what events show."""
    running = F.coalesce(snapshot, F.lit(False)) & ~F.coalesce(completed, F.lit(False))
    return F.struct(running.alias("running"), F.when(running, "true").otherwise("false").alias("marker"))


def snapshot_progress(df: DataFrame, n: int, *, seq: str = SEQ) -> DataFrame:
    """Rows scanned per table, partitions committed, and whether all ``n`` have. A log holds one table's snapshot."""
    commits = snapshot_commits(df, n, seq=seq).scalar()
    own = F.get(commits, F.col("PartitionId"))
    is_row = ~F.col("Type").isin(BEGIN_SNAPSHOT, COMMIT_SNAPSHOT) & (own.isNull() | (F.col(seq) < own))
    counted = df.groupBy("Table").agg(F.count_if(is_row).alias("rows_scanned")).withColumn("__commits", commits)
    seen = F.size(F.filter("__commits", lambda c: c.isNotNull())).cast("bigint")
    return counted.select("Table", "rows_scanned", seen.alias("partitions_committed"), (seen >= n).alias("completed"))


def snapshot_notifications(
    df: DataFrame, n: int, channels: str | None = "sink", *, ts: str = "ts_ms"
) -> DataFrame:
    """A STARTED row at the first begin, and a COMPLETED row at the last commit once all have committed.

    ``ts`` names the column with the moment of each record in milliseconds.
    Without a channel there are no notifications.
    """
    per_partition = (
        df.where(F.col("Type").isin(BEGIN_SNAPSHOT, COMMIT_SNAPSHOT))
        .groupBy("PartitionId")
        .agg(
            F.min(F.when(F.col("Type") == BEGIN_SNAPSHOT, F.col(ts))).alias("__begun"),
            F.min(F.when(F.col("Type") == COMMIT_SNAPSHOT, F.col(ts))).alias("__committed"),
        )
    )
    facts = per_partition.agg(
        F.min("__begun").alias("__begun"),
        F.max("__committed").alias("__done"),
        F.count("__committed").alias("__commits"),
    )
    rows = F.array(
        F.struct(F.lit(STARTED).alias("type"), F.col("__begun").alias("timestamp")),
        F.struct(F.lit(COMPLETED).alias("type"), F.when(F.col("__commits") >= n, F.col("__done")).alias("timestamp")),
    )
    return (
        facts.where(F.lit(bool(channels)))
        .select(F.explode(rows).alias("row"))
        .where(F.col("row.timestamp").isNotNull())
        .select(F.lit(AGGREGATE_TYPE).alias("aggregate_type"), "row.type", "row.timestamp")
    )


def snapshot_then_stream(snapshot: DataFrame, changes: DataFrame, n: int, *, seq: str = SEQ) -> DataFrame:
    """Snapshot records, then the changes after the snapshot's last offset of each partition.

    A partition without snapshot rows has no offset and is read from its
    beginning. ``phase`` is 0 for the snapshot and 1 for changes; order by
    ``(phase, seq)``.
    """
    resumed = begin_at(changes, last_vector(snapshot, n, seq=seq))
    return snapshot.withColumn("phase", F.lit(0)).unionByName(resumed.withColumn("phase", F.lit(1)))
