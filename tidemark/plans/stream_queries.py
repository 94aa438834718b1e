"""Streaming queries, drained with ``availableNow`` and read back."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.offsets import format_offsets
from ..operators import envelope as oe
from ..operators.offsets import BUCKET_ROWS
from ..session import fresh_path
from ..sources.changelog import change_stream
from ..config import CdcConfig
from ..streaming.keyed_log import FileLog
from ..streaming.runner import Capture, capture, open_changes, read_events, run_cdc
from ..streaming.table import compact_state, read_state, write_state_batch
from . import fixtures as fx
from .event_queries import E, START, V, _BOUND, _STARTED, ts
from .fixtures import EVENTS_CONFIG, EVENTS_TABLE
from .registry import query
from .snapshot_queries import CUSTOMER_TABLE, S, SNAP_SLOTS, TS_BASE

CHUNKS = 3
# Records of a staged file.
FILE_ROWS = BUCKET_ROWS
# A micro-batch knows the span of its records, so it needs no small buckets to be quick.
STREAM_CONFIG = replace(EVENTS_CONFIG, snapshot_mode="no_data", bucket_rows=BUCKET_ROWS)


def stage_log(spark: SparkSession, log: DataFrame, path: str, chunks: range, total: int = CHUNKS) -> int:
    """Appends parts of a log in arrival order, as a writer of the log would, and returns how many files each part has.

    The files of a part are written at once and land in any order, so a batch must take a
    part whole: all parts have as many files, one for each range of numbers. Where a range
    would be empty, which would leave a file out, a part is one file.
    """
    known = log.agg(F.max("seq").alias("high"), F.count("seq").alias("rows")).first()
    top = F.lit(1 if known["high"] is None else known["high"] + 1).cast("bigint")

    def place(ranges: int) -> Column:
        return F.call_function("div", F.col("seq") * ranges, top)

    files = max(1, -(-known["rows"] // (FILE_ROWS * total)))
    if files > 1 and log.select(place(total * files).alias("place")).distinct().count() < total * files:
        files = 1
    for chunk in chunks:
        part = log.where(place(total) == chunk).repartitionById(files, F.pmod(place(total * files), F.lit(files)).cast("int"))
        part.sortWithinPartitions("seq").write.mode("append").parquet(path)
    return files


def _drain(spark, job: Capture, path: str, mixed: bool = False, *, files: int = 1, **options) -> None:
    changes = open_changes(spark, job, path, mixed, max_files=files)
    started = run_cdc(spark, job, changes, **options)
    if started is not None:
        started.awaitTermination()


def _records(events: DataFrame) -> DataFrame:
    return events.select(
        "seq",
        F.col("key.user_id").alias("key_user_id"),
        "is_tombstone",
        F.col("value.op").alias("op"),
        F.col("value.ts_ms").alias("ts_ms"),
        format_offsets("value.source.offsets").alias("offsets"),
        *[F.col(f"value.after.{c}").alias(f"after_{c}") for c in ("user_id", "event_type", "value", "props", "ts")],
        F.col("value.source.txId").alias("tx"),
    )


_AFTER = ", ".join(
    f"CASE WHEN op <> 'd' THEN {'us' if c == 'ts' else c} END AS after_{c}" for c in ("user_id", "event_type", "value", "props", "ts")
)
RECORDS_SQL = (
    f"SELECT seq, user_id AS key_user_id, false AS is_tombstone, op, ms AS ts_ms, offsets, {_AFTER}, tx FROM vec "
    "UNION ALL SELECT seq, user_id, true, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM vec WHERE op = 'd'"
)


def _job(spark, label: str, config=STREAM_CONFIG) -> tuple[Capture, str]:
    root = fresh_path(spark, label)
    return Capture(config, EVENTS_TABLE, f"{root}/out", f"{root}/state", ts_ms=ts()), f"{root}/log"


@query("stream_cdc_events", V + RECORDS_SQL)
def stream_cdc_events_query(spark, sf_dir):
    job, log = _job(spark, "stream-cdc")
    files = stage_log(spark, fx.events_changelog(spark, sf_dir), log, range(CHUNKS))
    _drain(spark, job, log, files=files)
    return _records(read_events(spark, job))


@query("stream_resume", V + RECORDS_SQL)
def stream_resume_query(spark, sf_dir):
    job, path = _job(spark, "stream-resume")
    log = fx.events_changelog(spark, sf_dir)
    files = stage_log(spark, log, path, range(1))
    _drain(spark, job, path, files=files)
    stage_log(spark, log, path, range(1, CHUNKS))
    _drain(spark, job, path, files=files)
    return _records(read_events(spark, job))


@query(
    "stream_from_offsets",
    E
    + f"""SELECT seq, op, concat_ws(',', {_STARTED}) AS offsets FROM ev WHERE {_BOUND}
      WINDOW w AS (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def stream_from_offsets_query(spark, sf_dir):
    text = ",".join(o or "null" for o in START)
    job, log = _job(spark, "stream-offsets", replace(STREAM_CONFIG, offsets=text, tombstones=False))
    files = stage_log(spark, fx.events_changelog(spark, sf_dir), log, range(CHUNKS))
    _drain(spark, job, log, files=files)
    events = read_events(spark, job)
    return events.select("seq", "value.op", format_offsets("value.source.offsets").alias("offsets"))


@query(
    "stream_after_snapshot",
    S
    + f""", last AS (SELECT pid, max(off) AS off FROM snap GROUP BY pid),
      both_phases AS (
        SELECT 0 AS phase, seq, pid, off, c_custkey FROM snap
        UNION ALL SELECT 1, slog.seq, pid, slog.off, c_custkey FROM slog LEFT JOIN last USING (pid)
        WHERE last.off IS NULL OR slog.off > last.off)
      SELECT phase, seq, c_custkey AS key_custkey, CASE phase WHEN 0 THEN 'r' ELSE 'c' END AS op,
        CASE WHEN phase = 1 THEN 'false' WHEN seq = (SELECT min(seq) FROM snap) THEN 'first' ELSE 'true' END AS snapshot,
        concat_ws(',', {SNAP_SLOTS}) AS offsets
      FROM both_phases WINDOW w AS (ORDER BY phase, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def stream_after_snapshot_query(spark, sf_dir):
    root = fresh_path(spark, "stream-snapshot")
    job = Capture(
        replace(fx.CUSTOMER_CONFIG, bucket_rows=BUCKET_ROWS), CUSTOMER_TABLE, f"{root}/out", f"{root}/state", ts_ms=F.col("seq") + TS_BASE
    )
    files = stage_log(spark, fx.customer_changes(spark, sf_dir), f"{root}/log", range(CHUNKS))
    _drain(spark, job, f"{root}/log", files=files, snapshot=fx.customer_snapshot(spark, sf_dir))
    return read_events(spark, job).select(
        F.when(F.col("batch") == 0, 0).otherwise(1).alias("phase"),
        "seq",
        F.col("key.c_custkey").alias("key_custkey"),
        "value.op",
        "value.source.snapshot",
        format_offsets("value.source.offsets").alias("offsets"),
    )


@query(
    "stream_current_state",
    E
    + """SELECT user_id, seq, op, event_type, value FROM
      (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq DESC) AS rn FROM ev) WHERE rn = 1 AND op <> 'd'""",
)
def stream_current_state_query(spark, sf_dir):
    root = fresh_path(spark, "stream-state")
    files = stage_log(spark, fx.events_changelog(spark, sf_dir), f"{root}/log", range(CHUNKS))
    changes = oe.event_key(oe.map_op(oe.drop_markers(change_stream(spark, f"{root}/log", EVENTS_TABLE, max_files=files))), ["user_id"])
    events = changes.select("key", "seq", "op", F.struct("event_type", "value").alias("after"))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_state_batch(batch, f"{root}/table", batch_id)
        if batch_id == 1:
            compact_state(batch.sparkSession, f"{root}/table")

    stream = events.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/checkpoint")
    stream.trigger(availableNow=True).start().awaitTermination()
    return read_state(spark, f"{root}/table").select("key.user_id", "seq", "op", "after.event_type", "after.value")


@dataclass(frozen=True)
class Interrupted(Capture):
    """A job whose second batch dies after its events were written, before its offset is stored."""

    def write(self, events: DataFrame, run: int, batch: int, part: int = 0) -> None:
        super().write(events, run, batch, part)
        if batch == 2:
            raise RuntimeError("lost after the write")


@query("stream_retry", V + RECORDS_SQL)
def stream_retry_query(spark, sf_dir):
    job, log = _job(spark, "stream-retry")
    files = stage_log(spark, fx.events_changelog(spark, sf_dir), log, range(CHUNKS))
    try:
        _drain(spark, Interrupted(job.config, job.table, job.out, job.state, ts_ms=job.ts_ms), log, files=files)
    except StreamingQueryException as problem:
        if "lost after the write" not in str(problem):
            raise
    _drain(spark, job, log, files=files)
    return _records(read_events(spark, job))


SHUFFLED = (1, 3, 0, 2)


@query("stream_shuffled", V + RECORDS_SQL)
def stream_shuffled_query(spark, sf_dir):
    """The files of the log arrive out of order: later ones wait for those that are missing."""
    job, path = _job(spark, "stream-shuffled", replace(STREAM_CONFIG, arrival_order="hold"))
    log = fx.events_changelog(spark, sf_dir)
    for chunk in SHUFFLED:
        files = stage_log(spark, log, path, range(chunk, chunk + 1), len(SHUFFLED))
        _drain(spark, job, path, files=files)
    return _records(read_events(spark, job))


@query(
    "stream_gaps",
    f"""WITH sizes AS (SELECT max(event_id) + 1 AS top FROM events),
      chunks AS (SELECT (event_id * {len(SHUFFLED)}) // top AS chunk, min(event_id) AS low, max(event_id) AS high
        FROM events, sizes GROUP BY 1)
      SELECT 1::BIGINT AS batch, low AS gap_begin, high AS gap_end FROM chunks WHERE chunk = 0
      UNION ALL SELECT 2, low, high FROM chunks WHERE chunk IN (0, 2) UNION ALL SELECT 3, low, high FROM chunks WHERE chunk = 2""",
)
def stream_gaps_query(spark, sf_dir):
    """What each batch of the shuffled log still waits for."""
    job, path = _job(spark, "stream-gaps", replace(STREAM_CONFIG, arrival_order="hold"))
    log = fx.events_changelog(spark, sf_dir)
    for chunk in SHUFFLED:
        files = stage_log(spark, log, path, range(chunk, chunk + 1), len(SHUFFLED))
        _drain(spark, job, path, files=files)
    found = spark.read.parquet(f"{job.out}/gaps")
    return found.select(F.col("batch").cast("bigint").alias("batch"), "gap_begin", "gap_end")


# A job as its options file gives it.
JOB_OPTIONS = {
    "topic.prefix": fx.PREFIX,
    "database.dbname": fx.DB,
    "database.table": fx.TABLE,
    "database.partitions": str(fx.PARTITIONS),
    "snapshot.mode": "no_data",
    "custom.metric.tags": "env=prod,team=data",
}
CHUNK_SQL = f"(seq * {CHUNKS}) // (SELECT max(event_id) + 1 FROM events)"


def _part_size(spark, sf_dir) -> int:
    """A size that cuts every batch in a few parts, whatever the table's size."""
    return max(1, fx.load(spark, sf_dir, "events").count() // (CHUNKS * 4))


@dataclass(frozen=True)
class Cut(Capture):
    """A job that dies once inside its second batch, after a part was written and before its offset is stored."""

    def write(self, events: DataFrame, run: int, batch: int, part: int = 0) -> None:
        super().write(events, run, batch, part)
        if (batch, part) == (2, 1):
            raise RuntimeError("lost after the write")


@query(
    "stream_event_batches",
    V
    + f""", sized AS (SELECT greatest(1, count(*) // {CHUNKS * 4}) AS most FROM events),
      placed AS (SELECT *, {CHUNK_SQL} + 1 AS batch FROM vec),
      parts AS (SELECT *, (row_number() OVER (PARTITION BY batch ORDER BY seq) - 1) // most AS part FROM placed, sized)
      SELECT seq, batch::BIGINT AS batch, part::BIGINT AS part, op, offsets FROM parts""",
)
def stream_event_batches_query(spark, sf_dir):
    """Micro-batches cut into parts of at most so many events; a job that dies between two parts goes on after the last."""
    options = {**JOB_OPTIONS, "max.batch.size": str(_part_size(spark, sf_dir)), "tombstones.on.delete": "false"}
    job, log = _job(spark, "stream-parts", CdcConfig.from_options(options))
    files = stage_log(spark, fx.events_changelog(spark, sf_dir), log, range(CHUNKS))
    try:
        _drain(spark, Cut(job.config, job.table, job.out, job.state, ts_ms=job.ts_ms), log, files=files)
    except StreamingQueryException as problem:
        if "lost after the write" not in str(problem):
            raise
    _drain(spark, job, log, files=files)
    place = [F.col(c).cast("bigint").alias(c) for c in ("batch", "part")]
    return read_events(spark, job).select("seq", *place, "value.op", format_offsets("value.source.offsets").alias("offsets"))


@dataclass(frozen=True)
class Broken(FileLog):
    """A log that takes a share of one part's messages and then fails, once."""

    part: str = "0:2:0"

    def append(self, messages: DataFrame) -> None:
        if messages.where(F.col("part") == self.part).limit(1).count() == 0:
            return super().append(messages)
        super().append(messages.where("seq % 3 = 0"))
        raise RuntimeError("the log went away")


@query(
    "stream_keyed_log",
    E
    + """SELECT seq, 'app.shop.user_events' AS topic, user_id AS key_user_id, is_tombstone, op, 1::BIGINT AS copies
      FROM (SELECT seq, user_id, false AS is_tombstone, op FROM ev UNION ALL SELECT seq, user_id, true, NULL FROM ev WHERE op = 'd')""",
)
def stream_keyed_log_query(spark, sf_dir):
    """Messages of a keyed log that failed halfway through a part: each is there once."""
    job, path = _job(spark, "stream-log")
    log = FileLog(f"{path}-messages")
    files = stage_log(spark, fx.events_changelog(spark, sf_dir), path, range(CHUNKS))
    try:
        _drain(spark, replace(job, log=Broken(log.path)), path, files=files)
    except StreamingQueryException as problem:
        if "the log went away" not in str(problem):
            raise
    _drain(spark, replace(job, log=log), path, files=files)
    sent = log.read(spark)
    own = [F.get_json_object("key", "$.payload.user_id").cast("bigint").alias("key_user_id"), F.get_json_object("value", "$.payload.op").alias("op")]
    return sent.groupBy("seq", "topic", *own, "is_tombstone").agg(F.count(F.lit(1)).alias("copies"))


@query(
    "stream_metrics",
    E
    + f"""SELECT ({CHUNK_SQL} + 1)::BIGINT AS batch, count(*) AS total_events, count(*) FILTER (op = 'c') AS total_creates,
      count(*) FILTER (op = 'u') AS total_updates, count(*) FILTER (op = 'd') AS total_deletes, 'prod' AS tag_env, 'data' AS tag_team
      FROM ev GROUP BY 1""",
)
def stream_metrics_query(spark, sf_dir):
    """Counters of each batch of a running job, with the tags of its options."""
    job, log = _job(spark, "stream-metrics", CdcConfig.from_options(JOB_OPTIONS))
    files = stage_log(spark, fx.events_changelog(spark, sf_dir), log, range(CHUNKS))
    _drain(spark, job, log, files=files)
    rows = spark.read.parquet(f"{job.out}/metrics")
    counters = ["total_events", "total_creates", "total_updates", "total_deletes"]
    tags = [F.col("tags")[t].alias(f"tag_{t}") for t in ("env", "team")]
    return rows.select(F.col("batch").cast("bigint").alias("batch"), *counters, *tags)


# The catalog's rows for the events table.
EVENTS_COLUMNS = [
    ("user_id", "BIGINT", 1, False, None, True),
    ("event_type", "VARCHAR(20)", 2, True, 20, False),
    ("value", "DOUBLE", 3, True, None, False),
    ("props", "JSON", 4, True, None, False),
    ("ts", "DATETIME(6)", 5, True, 26, False),
]


@query("stream_from_options", V + RECORDS_SQL)
def stream_from_options_query(spark, sf_dir):
    """A job from its options and the catalog alone, over a log that holds other tables and databases too."""
    root = fresh_path(spark, "stream-options")
    columns = spark.createDataFrame(
        EVENTS_COLUMNS, "column_name string, type_name string, position int, nullable boolean, length int, primary_key boolean"
    )
    known = fx.load(spark, sf_dir, "events").select((F.col("user_id") % fx.PARTITIONS + 1).alias("num_partitions"))
    options = {k: v for k, v in JOB_OPTIONS.items() if k != "database.partitions"}
    job = capture(options, columns, known, f"{root}/out", f"{root}/state", ts_ms=ts())
    log = fx.events_changelog(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("db", F.lit(fx.DB))
    others = [
        log.withColumn("Table", F.lit("other")),
        log.withColumn("db", F.lit("elsewhere")),
        log.withColumn("db", F.lit("cluster")),
        log.withColumn("db", F.lit(None).cast("string")),
    ]
    for other in others:
        log = log.unionByName(other)
    files = stage_log(spark, log, f"{root}/log", range(CHUNKS))
    _drain(spark, job, f"{root}/log", mixed=True, files=files)
    return _records(read_events(spark, job))
