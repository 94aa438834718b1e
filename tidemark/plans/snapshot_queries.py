"""Queries over the bounded snapshot log of ``customer``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import offsets as fo
from ..operators import metrics as om
from ..operators import offsets as oo
from ..operators import snapshot as osn
from ..session import fresh_path
from ..sources.changelog import snapshot_scan
from . import fixtures as fx
from .fixtures import CUSTOMER_CONFIG, PARTITIONS, PREFIX, SNAPSHOT_SQL
from .pipeline import cdc_events
from .registry import query

S = f"WITH {SNAPSHOT_SQL} "
TS_BASE = 1_700_000_000_000

CUSTOMER_TABLE = StructType(
    [
        StructField("c_custkey", LongType(), False, {"type": "BIGINT", "primary_key": True}),
        StructField("c_name", StringType(), True, {"type": "VARCHAR(25)", "length": 25}),
        StructField("c_nationkey", IntegerType(), True, {"type": "INT", "length": 10, "scale": 0}),
        StructField("c_acctbal", DoubleType(), True, {"type": "DOUBLE"}),
        StructField("c_mktsegment", StringType(), True, {"type": "VARCHAR(10)", "length": 10}),
    ]
)

SNAP_SLOTS = ", ".join(
    f"coalesce(last_value(CASE WHEN pid = {i} THEN off END IGNORE NULLS) OVER w, 'null')" for i in range(PARTITIONS)
)


@query("snapshot_rows", S + "SELECT seq, pid::INTEGER AS partition_id, c_custkey FROM snap")
def snapshot_rows_query(spark, sf_dir):
    rows = osn.snapshot_rows(fx.customer_snapshot(spark, sf_dir), PARTITIONS)
    return rows.select("seq", F.col("PartitionId").alias("partition_id"), "c_custkey")


@query("snapshot_scan", S + "SELECT seq, c_custkey, c_name, c_acctbal FROM snap")
def snapshot_scan_query(spark, sf_dir):
    path = fresh_path(spark, "snapshot-log")
    fx.customer_snapshot(spark, sf_dir).write.parquet(path)
    return snapshot_scan(spark, path, CUSTOMER_TABLE, PARTITIONS).select("seq", "c_custkey", "c_name", "c_acctbal")


@query(
    "snapshot_events",
    S
    + f"""SELECT seq, 'r' AS op, c_custkey AS key_custkey, c_name, c_acctbal,
      CASE WHEN seq = min(seq) OVER () THEN 'first' ELSE 'true' END AS snapshot, concat_ws(',', {SNAP_SLOTS}) AS offsets
      FROM snap WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def snapshot_events_query(spark, sf_dir):
    events = cdc_events(
        fx.customer_snapshot(spark, sf_dir), CUSTOMER_TABLE, CUSTOMER_CONFIG, snapshot=True, ts_ms=F.col("seq") + TS_BASE
    )
    return events.select(
        "seq",
        "op",
        F.col("key.c_custkey").alias("key_custkey"),
        "after.c_name",
        "after.c_acctbal",
        "source.snapshot",
        fo.format_offsets("source.offsets").alias("offsets"),
    )


@query(
    "snapshot_first_mark",
    S + "SELECT seq, CASE WHEN seq = (SELECT min(seq) FROM snap) THEN 'first' ELSE 'true' END AS snapshot FROM snap",
)
def snapshot_first_mark_query(spark, sf_dir):
    return osn.mark_first(osn.snapshot_rows(fx.customer_snapshot(spark, sf_dir), PARTITIONS)).select("seq", "snapshot")


@query(
    "snapshot_then_stream",
    S
    + """, last AS (SELECT pid, max(off) AS off FROM snap GROUP BY pid)
      SELECT 0 AS phase, seq, c_custkey FROM snap
      UNION ALL SELECT 1, slog.seq, c_custkey FROM slog LEFT JOIN last USING (pid) WHERE last.off IS NULL OR slog.off > last.off""",
)
def snapshot_then_stream_query(spark, sf_dir):
    snap = osn.snapshot_rows(fx.customer_snapshot(spark, sf_dir), PARTITIONS)
    whole = osn.snapshot_then_stream(snap, fx.customer_changes(spark, sf_dir), PARTITIONS)
    return whole.select("phase", "seq", "c_custkey")


@query(
    "snapshot_then_stream_gap",
    S
    + """, kept AS (SELECT * FROM snap WHERE pid <> 3), last AS (SELECT pid, max(off) AS off FROM kept GROUP BY pid)
      SELECT 0 AS phase, seq, c_custkey FROM kept
      UNION ALL SELECT 1, slog.seq, c_custkey FROM slog LEFT JOIN last USING (pid) WHERE last.off IS NULL OR slog.off > last.off""",
)
def snapshot_then_stream_gap_query(spark, sf_dir):
    # Partition 3 has no snapshot rows, so it has no offset and is read from its beginning.
    snap = osn.snapshot_rows(fx.customer_snapshot(spark, sf_dir), PARTITIONS).where("PartitionId <> 3")
    whole = osn.snapshot_then_stream(snap, fx.customer_changes(spark, sf_dir), PARTITIONS)
    return whole.select("phase", "seq", "c_custkey")


@query(
    "snapshot_progress",
    S + """SELECT 'customer' AS "Table", count(*) AS rows_scanned, 8 AS partitions_committed, true AS completed FROM snap""",
)
def snapshot_progress_query(spark, sf_dir):
    return osn.snapshot_progress(fx.customer_snapshot(spark, sf_dir), PARTITIONS)


@query(
    "snapshot_notifications",
    S
    + f"""SELECT 'Initial Snapshot' AS aggregate_type, 'STARTED' AS type, {TS_BASE} + min(begin_seq) AS timestamp FROM begins
      UNION ALL SELECT 'Initial Snapshot', 'COMPLETED', {TS_BASE} + max(commit_seq) FROM commits""",
)
def snapshot_notifications_query(spark, sf_dir):
    log = fx.customer_snapshot(spark, sf_dir).withColumn("ts_ms", F.col("seq") + TS_BASE)
    return osn.snapshot_notifications(log, PARTITIONS)


@query(
    "snapshot_heartbeat",
    S
    + """, last AS (SELECT pid, max(off) AS off FROM snap GROUP BY pid)
      SELECT '__heartbeat.app' AS topic, (SELECT string_agg(coalesce(off, 'null'), ',' ORDER BY p)
        FROM range(8) r(p) LEFT JOIN last ON last.pid = p) AS offsets""",
)
def snapshot_heartbeat_query(spark, sf_dir):
    snap = osn.snapshot_rows(fx.customer_snapshot(spark, sf_dir), PARTITIONS)
    vector = oo.last_vector(snap, PARTITIONS)
    return om.snapshot_heartbeat(vector, CUSTOMER_CONFIG.heartbeat_prefix, PREFIX)
