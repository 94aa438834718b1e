"""Running a capture job: snapshot, hand-over, micro-batches, exactly-once output.

Everything a batch writes goes under its own run, batch and part, and replaces
what an earlier attempt left there, so a repeated batch changes nothing. A part
starts from the vector that was stored with the one before it; a batch that was
finished before the checkpoint took note is not written again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..config import CdcConfig
from ..functions.offsets import to_hex
from ..hooks import Hooks
from ..logschema import CHANGES
from ..operators.arrival import OutOfOrderError, arrival_gaps, complete_upto, event_cuts
from ..operators.metrics import metric_tags, observe_counters
from ..operators.offsets import begin_at
from ..operators.sinks import to_messages, write_events
from ..operators.snapshot import snapshot_complete, snapshot_notifications, snapshot_rows
from ..plans.pipeline import cdc_events, cdc_records, rejected_records
from ..sources.catalog import partition_count, table_schema
from ..sources.changelog import change_stream
from .keyed_log import KafkaLog, KeyedLog, send_once
from .start import Offset, StaleOffsetError, StartPlan, check_retained, load_offset, plan_start, save_offset
from .table import write_state_batch


def now_ms() -> int:
    return time.time_ns() // 1_000_000


@dataclass(frozen=True)
class Capture:
    """A capture job: one table's logs, and the folders for events and for state.

    With a ``log`` (or ``kafka`` options), events also go to their topics, once each
    (see ``streaming.keyed_log``). ``live`` is the folder of a current-state table that
    the job keeps (see ``streaming.table``). ``oldest`` gives the oldest offsets still
    held, one row, and is asked before every batch. ``clock`` gives milliseconds.
    """

    config: CdcConfig
    table: StructType
    out: str
    state: str
    hooks: Hooks = field(default_factory=Hooks)
    ts_ms: Column | None = None
    kafka: dict[str, str] | None = None
    live: str | None = None
    log: KeyedLog | None = None
    oldest: Callable[[SparkSession], DataFrame] | None = None
    clock: Callable[[], int] = now_ms

    def write(self, events: DataFrame, run: int, batch: int, part: int = 0) -> None:
        folder = self.folder("events", run, batch, part)
        records = cdc_records(events, self.config)
        write_events(records, folder)
        if self.live is not None:
            write_state_batch(events, self.live, batch, run, part)
        log = KafkaLog(self.kafka) if self.log is None and self.kafka is not None else self.log
        if log is not None:
            # A part without events leaves no file that would tell its schema.
            written = events.sparkSession.read.schema(records.schema).parquet(folder)
            name = f"{self.config.topic_prefix}.{self.config.db}.{self.config.table}"
            send_once(log, to_messages(written, name, self.table), self.state, f"{run}:{batch}:{part}")

    def folder(self, kind: str, run: int, batch: int, part: int = 0) -> str:
        return f"{self.out}/{kind}/run={run}/batch={batch}/part={part}"


@dataclass(frozen=True)
class Advance:
    """What bounded records do to an offset: how many data records there are, and the lowest ``seq`` of all."""

    offset: Offset
    records: int
    low: int | None


def advance(rows: DataFrame, offset: Offset) -> Advance:
    """The offset after the records (markers move only the frontier): one row of fixed size reaches the driver."""
    n = len(offset.vector)
    data = F.col("Type").isin(*CHANGES)
    place = F.struct(to_hex("TxId").alias("tx"), F.col("PartitionId").alias("pid"))
    last = rows.agg(
        F.min("seq").alias("low"),
        F.max("seq").alias("high"),
        F.count_if(data).alias("records"),
        F.max_by(place, F.when(data, F.col("seq"))).alias("place"),
        *[F.max_by("Offset", F.when(data & (F.col("PartitionId") == i), F.col("seq"))).alias(f"o{i}") for i in range(n)],
    ).first()
    if last["low"] is None:
        return Advance(offset, 0, None)
    frontier = last["high"] if offset.frontier is None else max(offset.frontier, last["high"])
    vector = [old if last[f"o{i}"] is None else last[f"o{i}"].hex() for i, old in enumerate(offset.vector)]
    moved = replace(offset, vector=vector, frontier=frontier)
    if last["place"] is not None:
        moved = replace(moved, tx_id=last["place"]["tx"], partition_id=last["place"]["pid"])
    return Advance(moved, last["records"], last["low"])


def _heartbeat(spark: SparkSession, job: Capture, offset: Offset, always: bool = False) -> Offset:
    """At most one heartbeat in an interval of the clock, whoever asks: it is named by its interval."""
    size = job.config.heartbeat_interval_ms
    if size <= 0 and not always:
        return offset
    moment = job.clock()
    interval = moment // size if size > 0 else 0
    if offset.beat is not None and interval <= offset.beat and not always:
        return offset
    text = ",".join(o or "null" for o in offset.vector)
    spark.range(1).select(
        F.lit(f"{job.config.heartbeat_prefix}.{job.config.topic_prefix}").alias("topic"),
        F.lit(text).alias("offsets"),
        F.lit(moment).cast("bigint").alias("ts_ms"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{job.out}/heartbeats/run={offset.run}/interval={interval}")
    return replace(offset, beat=interval)


def _write_rejects(job: Capture, log: DataFrame, run: int, batch: int, part: int = 0, snapshot: bool = False) -> None:
    bad = rejected_records(log, job.table, job.config, snapshot=snapshot, hooks=job.hooks)
    bad.write.mode("overwrite").parquet(job.folder("rejects", run, batch, part))


def _write_events(job: Capture, events: DataFrame, offset: Offset) -> None:
    """Writes a part's events; its counters, with the job's tags, come from the same pass."""
    seen = Observation()
    job.write(observe_counters(events, seen), offset.run, offset.batch, offset.part)
    spark = events.sparkSession
    row = spark.range(1).select(*[F.lit(v).cast("bigint").alias(k) for k, v in seen.get.items()], F.lit(job.clock()).alias("ts_ms"))
    row = metric_tags(row, job.config.metric_tags).coalesce(1)
    row.write.mode("overwrite").parquet(job.folder("metrics", offset.run, offset.batch, offset.part))


def _notify(job: Capture, log: DataFrame, run: int, batch: int, begun: int) -> None:
    """Both notifications of a snapshot, each with its own moment, and the topic they go to."""
    moments = F.when(F.col("Type") == "BeginSnapshot", F.lit(begun)).otherwise(F.lit(job.clock()))
    moment = (job.ts_ms if job.ts_ms is not None else moments).cast("bigint")
    rows = snapshot_notifications(log.withColumn("ts_ms", moment), job.config.partitions, job.config.notification_channels)
    rows = rows.withColumn("topic", F.lit(job.config.notification_topic).cast("string"))
    rows.write.mode("overwrite").parquet(job.folder("notifications", run, batch))


def take_snapshot(spark: SparkSession, job: Capture, log: DataFrame, start: Offset) -> Offset:
    """Writes the snapshot's events and stores the offset they end at.

    The offset is stored as unfinished first, so a job that dies on the way
    takes the snapshot again, over the same folder.
    """
    config, begun = job.config, job.clock()
    start = save_offset(spark, job.state, replace(start, snapshot=True, completed=False))
    if not snapshot_complete(log, config.partitions).first()["completed"]:
        raise RuntimeError("the snapshot log ends before every partition has committed")
    ahead = advance(snapshot_rows(log, config.partitions), start)
    events = cdc_events(
        log,
        job.table,
        config,
        snapshot=True,
        start=start.vector,
        records=ahead.records,
        ts_ms=job.ts_ms,
        hooks=job.hooks,
    )
    _write_events(job, events, start)
    if config.failure_mode == "warn":
        _write_rejects(job, log, start.run, start.batch, snapshot=True)
    if config.notification_channels:
        _notify(job, log, start.run, start.batch, begun)
    # The snapshot's arrival numbers are its own; those of the changes begin anew.
    done = replace(ahead.offset, snapshot=False, completed=True, frontier=None, start=ahead.offset.vector)
    return save_offset(spark, job.state, _heartbeat(spark, job, done, always=True))


def _held(job: Capture, offset: Offset) -> str:
    """Where the records wait that a batch could not emit yet: two folders in turn, so that the last one's is whole."""
    return f"{job.state}/held/run={offset.run}/turn={offset.batch % 2}"


def _in_order(job: Capture, batch: DataFrame, last: Offset, number: int) -> tuple[DataFrame, DataFrame | None, int]:
    """What may be emitted, in a log whose files come in any order; what waits for missing numbers; and up to where.

    With ``arrival_lag`` a number that far below the highest one is taken as never to come.
    """
    spark, config = batch.sparkSession, job.config
    again = last.batch == number
    frontier = config.arrival_first - 1 if last.frontier is None else last.frontier
    before = replace(last, batch=number - 1)
    rows = batch
    if not again:
        low = batch.agg(F.min("seq").alias("low")).first()["low"]
        if low is not None and low <= frontier:
            raise OutOfOrderError(f"the record {low} arrived after {frontier} was emitted")
    if last.held:
        rows = rows.unionByName(spark.read.schema(batch.schema).parquet(_held(job, before)))
    rows = rows.where(F.col("seq") > frontier)
    known = complete_upto(rows, frontier).first()
    if known["rows"] != known["numbers"]:
        raise OutOfOrderError(f"{known['rows'] - known['numbers']} arrival numbers after {frontier} occur twice")
    upto = known["upto"]
    if config.arrival_lag and known["highest"] - config.arrival_lag > upto:
        # What is missing up to there is given up; from there on the log may be complete again.
        upto = complete_upto(rows, known["highest"] - config.arrival_lag).first()["upto"]
    waiting = rows.where(F.col("seq") > upto) if upto < known["highest"] else None
    if upto < known["highest"] or upto > known["upto"]:
        missing = arrival_gaps(rows, frontier).withColumn("given_up", F.col("gap_end") <= upto)
        missing.write.mode("overwrite").parquet(job.folder("gaps", last.run, number))
    return rows.where(F.col("seq") <= upto), waiting, upto


def batch_writer(job: Capture, first: Offset) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a run that begins at the offset ``first``."""
    stored: list[Offset] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, config = batch.sparkSession, job.config
        number = first.batch + batch_id + 1
        # What this process stored last need not be read back; after a restart it is.
        last = stored[-1] if stored else load_offset(spark, job.state)
        if last is None or last.run != first.run or last.batch + (1 if last.whole else 0) not in (number, number + 1):
            raise RuntimeError(f"no offset is stored that batch {number} of run {first.run} can go on from")
        if last.batch == number and last.whole:
            return  # finished before the checkpoint took note
        if job.oldest is not None:
            check_retained(last.vector, job.oldest(spark))
        again = last.batch == number
        rows, waiting, held = batch, None, 0
        if config.arrival_order == "hold":
            rows, waiting, upto = _in_order(job, batch, last, number)
        elif again and last.frontier is not None:
            rows = batch.where(F.col("seq") > last.frontier)
        log = begin_at(rows, first.first_vector)
        part = last.part + 1 if again else 0
        offset = replace(last, snapshot=False, completed=True, batch=number, part=part, whole=False)
        ahead = advance(log, offset)
        if config.arrival_order == "check" and None not in (ahead.low, last.frontier) and ahead.low <= last.frontier:
            raise OutOfOrderError(f"the record {ahead.low} arrived after {last.frontier} was emitted")
        if waiting is not None:
            target = _held(job, offset)
            waiting.write.mode("overwrite").parquet(target)
            held = spark.read.schema(batch.schema).parquet(target).count()
        cuts: list[int] = []
        if config.max_batch_size and ahead.records > config.max_batch_size:
            data = log.where(F.col("Type").isin(*CHANGES))
            found = event_cuts(data, config.max_batch_size, config.bucket_rows).orderBy("part").collect()
            cuts = [r["last"] for r in found[:-1]]
        low = None
        for i, high in enumerate([*cuts, None]):
            piece = log if low is None else log.where(F.col("seq") > low)
            piece = piece if high is None else piece.where(F.col("seq") <= high)
            step = advance(piece, replace(offset, part=part + i)) if cuts else ahead
            done = step.offset
            events = cdc_events(
                piece, job.table, config, start=offset.vector, records=step.records, ts_ms=job.ts_ms, hooks=job.hooks
            )
            _write_events(job, events, done)
            if config.failure_mode == "warn":
                _write_rejects(job, piece, first.run, number, done.part)
            if high is None:
                done = replace(done, whole=True, held=held)
                if config.arrival_order == "hold":
                    done = replace(done, frontier=upto)
            offset = save_offset(spark, job.state, _heartbeat(spark, job, done))
            stored[:] = [offset]
            low = high

    return write


def run_cdc(
    spark: SparkSession,
    job: Capture,
    changes: DataFrame,
    snapshot: DataFrame | None = None,
    *,
    tails: DataFrame | None = None,
    oldest: DataFrame | None = None,
    available_now: bool = True,
    poll: str | None = None,
) -> StreamingQuery | None:
    """Starts or resumes a job. None when the mode does not stream.

    ``changes`` is a stream (see ``sources.change_stream``), ``snapshot`` the
    bounded log of the table. A run goes on from its checkpoint; a new start
    (first, reset, or from given offsets) opens a new run with a fresh one.
    """
    stored = load_offset(spark, job.state)
    if oldest is None and job.oldest is not None:
        oldest = job.oldest(spark)
    plan: StartPlan = plan_start(spark, job.config, stored, tails, oldest)
    # A run that has not moved yet has an empty vector, which is no offset to start from; without tails it goes on all the same.
    same = plan.start == "tails" and stored is not None and stored.finished and plan.vector == stored.vector
    resumed = stored is not None and not plan.snapshot and (plan.start == "stored" or same)
    if resumed:
        first = replace(stored, batch=0, part=0)
    else:
        # An unfinished snapshot is taken again in its own run, over what it left behind.
        run = 0 if stored is None else stored.run + (1 if stored.finished else 0)
        first = Offset(plan.vector, run=run, start=plan.vector, version=stored.version if stored else -1)
        if plan.snapshot:
            if snapshot is None:
                raise ValueError("this start takes a snapshot, but no snapshot log was given")
            first = take_snapshot(spark, job, snapshot, first)
        elif plan.stream:
            first = save_offset(spark, job.state, _heartbeat(spark, job, first, always=True))
    if not plan.stream:
        return None
    writer = changes.writeStream.foreachBatch(batch_writer(job, first)).option(
        "checkpointLocation", f"{job.state}/checkpoint/run={first.run}"
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll or f"{job.config.poll_interval_ms} milliseconds")
    return writer.start()


def follow(
    spark: SparkSession, job: Capture, changes: Callable[[], DataFrame], snapshot: Callable[[], DataFrame] | None = None, restarts: int = 1, **options
) -> None:
    """Runs a job until what is available has been read.

    In mode ``when_needed`` a log that was cut off behind a batch is met by a new
    start, which takes a new snapshot, at most ``restarts`` times; in the other modes
    the error goes to the caller, and trying again does not help.
    """
    while True:
        query = run_cdc(spark, job, changes(), snapshot() if snapshot else None, **options)
        if query is None:
            return
        try:
            query.awaitTermination()
            return
        except StreamingQueryException as problem:
            if StaleOffsetError.__name__ not in str(problem):
                raise
            if job.config.snapshot_mode != "when_needed" or restarts < 1:
                raise StaleOffsetError(str(problem)) from problem
            restarts -= 1


def run_heartbeats(spark: SparkSession, job: Capture) -> StreamingQuery:
    """A second query, on a timer: heartbeats also while no changes arrive.

    It writes nothing but heartbeats. Batches and the timer name a heartbeat by its
    interval, so an interval has one however many ask for it.
    """
    size = job.config.heartbeat_interval_ms
    if size <= 0:
        raise ValueError("heartbeat.interval.ms is not set")
    beats: list[Offset] = []

    def tick(_: DataFrame, __: int) -> None:
        newest = load_offset(spark, job.state)
        if newest is None:
            return
        known = [b.beat for b in (newest, *beats) if b.beat is not None and b.run == newest.run]
        beats[:] = [_heartbeat(spark, job, replace(newest, beat=max(known, default=None)))]

    timer = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return timer.writeStream.foreachBatch(tick).trigger(processingTime=f"{size} milliseconds").start()


def open_changes(spark: SparkSession, job: Capture, path: str, mixed: bool = False, **options) -> DataFrame:
    """The job's change stream over a folder, within the limits its options set; from a ``mixed`` log its own table's records."""
    limits = {"max_records": job.config.max_queue_size or None, "max_bytes": job.config.max_queue_bytes or None}
    own = (job.config.db, job.config.table) if mixed else None
    return change_stream(spark, path, job.table, of=own, **{**limits, **options})


def capture(options: dict[str, str], columns: DataFrame, partitions: DataFrame | None, out: str, state: str, **more) -> Capture:
    """A job from its options alone: the table's schema comes from the catalog's ``columns`` (see ``sources.catalog``), and
    the number of database partitions from its ``num_partitions``, unless the options give it."""
    if "database.partitions" not in options and partitions is not None:
        count = partition_count(partitions).first()["partitions"]
        options = {**options, "database.partitions": str(count)}
    return Capture(CdcConfig.from_options(options), table_schema(columns), out, state, **more)


def read_events(spark: SparkSession, job: Capture) -> DataFrame:
    """All events a job has written, with their run, batch and part numbers."""
    return spark.read.parquet(f"{job.out}/events")
