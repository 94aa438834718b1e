"""Buckets of equal depth, arrival order across batches, parts of batches, and what a running job leaves behind."""

from __future__ import annotations

import itertools
import random
import time
from dataclasses import dataclass, replace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_offsets import as_dict
from test_operators import CONFIG, TABLE, make_log

from tidemark.config import CdcConfig, ConfigError
from tidemark.functions.offsets import vector_literal
from tidemark.operators import arrival, buckets
from tidemark.operators import offsets as oo
from tidemark.operators.metrics import event_counters
from tidemark.plans.pipeline import cdc_events, cdc_records
from tidemark.sources.changelog import change_stream
from tidemark.streaming import offset_log as ol
from tidemark.streaming import start as st
from tidemark.streaming.keyed_log import FileLog, send_once
from tidemark.streaming.runner import Capture, follow, read_events, run_cdc, run_heartbeats


def one():
    return F.lit(1).cast("bigint")


@pytest.fixture(scope="module")
def changes(spark):
    kinds = ("Insert", "Update", "CommitTransaction", "Delete")
    return make_log(spark, [(kinds[i % 4], (i * i) % 4, i, i % 7, f"v{i}") for i in range(60)]).cache()


@pytest.fixture
def job(tmp_path):
    def make(kind=Capture, **options):
        own = {k: options.pop(k) for k in ("log", "oldest", "clock", "live") if k in options}
        config = replace(CONFIG, **{"snapshot_mode": "no_data", **options})
        return kind(config, TABLE, f"{tmp_path}/out", f"{tmp_path}/state", ts_ms=one(), **own)

    return make


def append(log, path, *parts):
    """Files in the order given; a later one is never older than an earlier one to the reader."""
    for low, high in parts:
        log.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)


def drain(spark, job, path, **options):
    query = run_cdc(spark, job, change_stream(spark, path, TABLE, max_files=1), **options)
    if query is not None:
        query.awaitTermination()


def rows(events):
    return sorted(
        (r["seq"], r["is_tombstone"], r["value"] and r["value"]["op"], r["value"] and tuple(r["value"]["source"]["offsets"]))
        for r in events.collect()
    )


def in_one_batch(changes, job):
    return rows(cdc_records(cdc_events(changes, TABLE, job.config, ts_ms=one()), job.config))


NUMBERS = {
    "dense": lambda rng, n: range(n),
    "cubes": lambda rng, n: [i**3 * 4_000_000 - (1 << 61) for i in range(n)],
    "one far": lambda rng, n: [*range(n - 1), (1 << 62)],
    "spread": lambda rng, n: sorted({rng.randrange(-(1 << 62), 1 << 62) for _ in range(n)}),
}


@pytest.mark.parametrize(
    "numbers, n, depth, fanout",
    [("dense", 5, 7, 4), ("cubes", 20, 50, 1 << 10), ("one far", 5, 50, 4), ("spread", 20, 7, 1 << 10), ("spread", 5, 10_000, 1 << 10)],
)
def test_vectors_of_any_numbers_equal_the_global_window(spark, numbers, n, depth, fanout):
    rng = random.Random(4)
    data = [(s, rng.randrange(n), bytes([i % 250, i // 250])) for i, s in enumerate(sorted(NUMBERS[numbers](rng, 700)))]
    log = spark.createDataFrame(data, "seq long, PartitionId int, Offset binary").repartition(4)
    found = oo.with_offset_vector(log, n, bucket_rows=depth, fanout=fanout)
    assert as_dict(found) == as_dict(oo.global_offset_vector(log, n))


@pytest.mark.parametrize("numbers", NUMBERS)
def test_no_step_orders_more_totals_than_the_bounds_allow(spark, numbers):
    values = list(NUMBERS[numbers](random.Random(1), 3000))
    frame = spark.createDataFrame([(v,) for v in values], "seq long")
    depths = buckets.depth_bounds(frame, 10, coarse=16, fanout=8)
    placed = frame.select("seq", buckets.depth_bucket(F.col("seq"), depths, 8).alias("b"))
    counts = [(r["b"], r["n"]) for r in placed.groupBy("b").agg(F.count("seq").alias("n")).collect()]
    coarse = {}
    for b, n in counts:
        coarse.setdefault(b // 8, []).append(n)
    assert len(coarse) <= 16 and all(len(c) <= 8 for c in coarse.values())
    assert max(sum(c) for c in coarse.values()) < 3 * len(values) / 16
    order = [r["b"] for r in placed.orderBy("seq").collect()]
    assert order == sorted(order)


@pytest.mark.parametrize("numbers", ["dense", "spread"])
def test_ranks(spark, numbers):
    values = list(NUMBERS[numbers](random.Random(2), 900))
    frame = spark.createDataFrame([(v, "x") for v in values], "seq long, other string").repartition(5)
    found = {r["seq"]: r["rank"] for r in buckets.with_rank(frame, 20, coarse=16, fanout=4).collect()}
    assert found == {v: i + 1 for i, v in enumerate(sorted(values))}
    cuts = arrival.event_cuts(frame, 250, 20).orderBy("part").collect()
    assert [(c["last"], c["rows"]) for c in cuts] == [(sorted(values)[i], k) for i, k in ((249, 250), (499, 250), (749, 250), (899, 150))]
    assert buckets.with_rank(frame.limit(0), 20).count() == 0


@pytest.mark.parametrize("missing", [[], [0], [5], [32_768], [32_767, 70_000], [99_999], [40_000, 40_001, 90_000]])
def test_how_far_a_log_is_complete(spark, missing):
    rows = spark.range(100_000).withColumnRenamed("id", "seq").where(~F.col("seq").isin(missing) if missing else F.lit(True))
    known = arrival.complete_upto(rows, -1).first()
    inside = [m for m in missing if m != 99_999]
    assert known["upto"] == (min(inside) - 1 if inside else 99_999 - len(missing))
    assert known["rows"] == known["numbers"] == 100_000 - len(missing)
    gaps = sorted((r["gap_begin"], r["gap_end"]) for r in arrival.arrival_gaps(rows, -1).collect())
    runs = [[m for _, m in g] for _, g in itertools.groupby(enumerate(inside), lambda p: p[1] - p[0])]
    assert gaps == [(r[0], r[-1]) for r in runs]


def test_completeness_of_nothing_and_of_repeats(spark):
    none = arrival.complete_upto(spark.range(0).withColumnRenamed("id", "seq"), 6).first()
    assert (none["upto"], none["highest"], none["rows"]) == (6, 6, 0)
    twice = spark.createDataFrame([(7,), (8,), (8,), (9,)], "seq long")
    known = arrival.complete_upto(twice, 6).first()
    assert (known["upto"], known["rows"], known["numbers"]) == (9, 4, 3)


def test_an_older_record_fails_the_job(spark, changes, job, tmp_path):
    path = f"{tmp_path}/log"
    append(changes, path, (30, 60), (0, 30))
    with pytest.raises(StreamingQueryException, match="arrived after 59 was emitted"):
        drain(spark, job(), path)
    kept = st.load_offset(spark, job().state)
    assert kept.batch == 1 and kept.frontier == 59


def test_any_order_is_taken_where_the_job_says_so(spark, changes, job, tmp_path):
    path = f"{tmp_path}/log"
    append(changes, path, (30, 60), (0, 30))
    drain(spark, job(arrival_order="any"), path)
    assert read_events(spark, job()).where("NOT is_tombstone").count() == 45


@pytest.mark.parametrize("order, most", [([(20, 40), (40, 60), (0, 20)], 0), ([(0, 10), (30, 60), (10, 30)], 7), ([(59, 60), (1, 59), (0, 1)], 0)])
def test_shuffled_files_give_the_vectors_of_the_whole_log(spark, changes, job, tmp_path, order, most):
    target, path = job(arrival_order="hold", max_batch_size=most), f"{tmp_path}/log"
    append(changes, path, *order)
    drain(spark, target, path)
    assert rows(read_events(spark, target)) == in_one_batch(changes, target)
    assert st.load_offset(spark, target.state).frontier == 59 and st.load_offset(spark, target.state).held == 0


def test_records_wait_over_a_restart_and_gaps_are_reported(spark, changes, job, tmp_path):
    target, path = job(arrival_order="hold"), f"{tmp_path}/log"
    append(changes, path, (0, 10), (20, 30), (40, 60))
    drain(spark, target, path)
    kept = st.load_offset(spark, target.state)
    assert (kept.frontier, kept.held) == (9, 30)
    gaps = spark.read.parquet(f"{target.out}/gaps").where("batch = 3").collect()
    assert sorted((g["gap_begin"], g["gap_end"], g["given_up"]) for g in gaps) == [(10, 19, False), (30, 39, False)]
    append(changes, path, (30, 40), (10, 20))
    drain(spark, target, path)
    assert rows(read_events(spark, target)) == in_one_batch(changes, target)
    append(changes, path, (12, 13))
    with pytest.raises(StreamingQueryException, match="the record 12 arrived after 59"):
        drain(spark, target, path)


def test_numbers_that_never_come_are_given_up(spark, changes, job, tmp_path):
    target, path = job(arrival_order="hold", arrival_lag=15), f"{tmp_path}/log"
    append(changes, path, (0, 10), (20, 30), (30, 60))
    drain(spark, target, path)
    assert st.load_offset(spark, target.state).frontier == 59
    assert rows(read_events(spark, target)) == in_one_batch(changes.where("seq < 10 OR seq >= 20"), target)
    assert spark.read.parquet(f"{target.out}/gaps").where("given_up").count() == 1


def test_a_record_that_comes_twice_fails_the_job(spark, changes, job, tmp_path):
    path = f"{tmp_path}/log"
    append(changes, path, (5, 20), (15, 30))
    with pytest.raises(StreamingQueryException, match="5 arrival numbers after -1 occur twice"):
        drain(spark, job(arrival_order="hold"), path)


@dataclass(frozen=True)
class Dies(Capture):
    """Dies once, before or after a part's events are written."""

    at: tuple[int, int] = (1, 1)
    before: bool = True

    def write(self, events, run, batch, part=0):
        if self.before and (batch, part) == self.at:
            raise RuntimeError("killed")
        super().write(events, run, batch, part)
        if (batch, part) == self.at:
            raise RuntimeError("killed")


@pytest.mark.parametrize("order, at, before", [("check", (1, 0), False), ("hold", (1, 1), True), ("check", (2, 2), False)])
def test_a_kill_between_parts_loses_and_repeats_nothing(spark, changes, job, tmp_path, order, at, before):
    target, path = job(max_batch_size=6, arrival_order=order, live=f"{tmp_path}/live"), f"{tmp_path}/log"
    append(changes, path, (0, 30), (30, 60))
    dying = Dies(target.config, TABLE, target.out, target.state, ts_ms=one(), live=target.live, at=at, before=before)
    with pytest.raises(StreamingQueryException, match="killed"):
        drain(spark, dying, path)
    drain(spark, target, path)
    events = read_events(spark, target)
    assert rows(events) == in_one_batch(changes, target)
    sizes = {(r["batch"], r["part"]): r["n"] for r in events.where("NOT is_tombstone").groupBy("batch", "part").agg(F.count("seq").alias("n")).collect()}
    assert max(sizes.values()) == 6 and len(sizes) == 8
    metrics = spark.read.parquet(f"{target.out}/metrics").agg(F.sum("total_events").alias("n")).first()["n"]
    assert metrics == sum(sizes.values())


def test_a_batch_that_was_finished_before_the_checkpoint_took_note_is_left_alone(spark, changes, job, tmp_path):
    target, path = job(), f"{tmp_path}/log"
    append(changes, path, (0, 30))
    drain(spark, target, path)
    newest = st.load_offset(spark, target.state)
    # As if the next batch were done, and only the checkpoint not yet written.
    st.save_offset(spark, target.state, replace(newest, batch=2, frontier=59))
    append(changes, path, (30, 60))
    drain(spark, target, path)
    assert {r["batch"] for r in read_events(spark, target).select("batch").distinct().collect()} == {1}


def test_fifty_offsets_leave_a_few_folders(spark, tmp_path):
    state, offset = str(tmp_path), ol.Offset(["aa", None], start=["00", None])
    for i in range(50):
        offset = ol.save_offset(spark, state, replace(offset, batch=i, frontier=i * 10))
    assert len([p for p in (tmp_path / "offsets").iterdir() if p.is_dir()]) == ol.SLOTS
    newest = ol.load_offset(spark, state)
    assert (newest.batch, newest.frontier, newest.version, newest.start) == (49, 490, 49, ["00", None])
    assert ol.load_offset(spark, state, 0, 48).batch == 48 and ol.load_offset(spark, state, 0, 3) is None
    # A save that died leaves an empty slot; the one before it counts.
    for file in (tmp_path / "offsets" / f"slot={49 % ol.SLOTS}").iterdir():
        file.rename(tmp_path / f"gone-{file.name}")
    assert ol.load_offset(spark, state).batch == 48


@dataclass(frozen=True)
class Flaky(FileLog):
    """Takes the messages with even numbers, then fails."""

    def append(self, messages):
        super().append(messages.where("seq % 2 = 0"))
        raise RuntimeError("log lost")


def test_messages_reach_a_log_once(spark, tmp_path):
    log, state = FileLog(f"{tmp_path}/log"), f"{tmp_path}/state"
    messages = spark.range(10).selectExpr("'t' AS topic", "string(id % 3) AS key", "string(id) AS value", "id AS seq", "false AS is_tombstone")
    for attempt in range(3):
        with pytest.raises(RuntimeError, match="log lost"):
            send_once(Flaky(log.path), messages, state, "0:1:0")
    send_once(log, messages, state, "0:1:0")
    send_once(log, messages, state, "0:1:0")
    send_once(log, messages.limit(4), state, "0:2:0")
    sent = sorted((r["part"], r["seq"]) for r in log.read(spark).collect())
    assert sent == [("0:1:0", i) for i in range(10)] + [("0:2:0", i) for i in range(4)]
    assert len([p for p in (tmp_path / "state" / "sent").iterdir() if p.is_dir()]) == 2


def test_a_job_sends_each_record_once(spark, changes, job, tmp_path):
    log, path = FileLog(f"{tmp_path}/messages"), f"{tmp_path}/log"
    append(changes, path, (0, 30), (30, 60))
    with pytest.raises(StreamingQueryException, match="log lost"):
        drain(spark, job(log=Flaky(log.path)), path)
    target = job(log=log)
    drain(spark, target, path)
    sent = sorted((r["seq"], r["is_tombstone"]) for r in log.read(spark).collect())
    assert sent == sorted((r["seq"], r["is_tombstone"]) for r in read_events(spark, target).collect())


def test_ten_batches_in_an_interval_give_one_heartbeat(spark, changes, job, tmp_path):
    moments = iter([1000] * 30 + [2500] * 200)
    target, path = job(heartbeat_interval_ms=1000, clock=lambda: next(moments)), f"{tmp_path}/log"
    append(changes, path, *[(i * 6, i * 6 + 6) for i in range(10)])
    drain(spark, target, path)
    beats = spark.read.parquet(f"{target.out}/heartbeats").collect()
    assert sorted(b["interval"] for b in beats) in ([1], [1, 2])
    assert st.load_offset(spark, target.state).batch == 10


def test_an_idle_job_still_gives_heartbeats(spark, changes, job, tmp_path):
    target, path = job(heartbeat_interval_ms=500), f"{tmp_path}/log"
    append(changes, path, (0, 60))
    drain(spark, target, path)
    before = spark.read.parquet(f"{target.out}/heartbeats").count()
    timer = run_heartbeats(spark, target)
    time.sleep(6)
    timer.stop()
    beats = spark.read.parquet(f"{target.out}/heartbeats").orderBy("interval").collect()
    assert len(beats) >= before + 2 and len({b["interval"] for b in beats}) == len(beats)
    newest = st.load_offset(spark, target.state)
    assert beats[-1]["offsets"] == ",".join(o or "null" for o in newest.vector) and newest.batch == 1


def test_counters_of_a_job_equal_those_of_its_output(spark, changes, job, tmp_path):
    target, path = job(metric_tags="env=prod,team=data", skipped_operations="u"), f"{tmp_path}/log"
    append(changes, path, (0, 25), (25, 60))
    drain(spark, target, path)
    metrics = spark.read.parquet(f"{target.out}/metrics")
    names = ["total_events", "total_creates", "total_updates", "total_deletes"]
    events = read_events(spark, target).where("NOT is_tombstone").select("value.op")
    assert metrics.agg(*[F.sum(n).alias(n) for n in names]).first() == event_counters(events).first()
    assert {tuple(sorted(r["tags"].items())) for r in metrics.collect()} == {(("env", "prod"), ("team", "data"))}


def hexes(*numbers):
    return [None if n is None else format(n, "048x") for n in numbers]


@dataclass
class Retention:
    """The oldest offsets a log still holds; cut off after a number of batches."""

    calls: int
    late: list

    def __call__(self, spark):
        self.calls -= 1
        return spark.range(1).select(vector_literal(hexes(0, 0, 0, 0) if self.calls >= 0 else self.late).alias("offsets"))


def test_a_log_that_is_cut_off_between_batches(spark, changes, job, tmp_path):
    path = f"{tmp_path}/log"
    append(changes, path, (0, 20), (20, 40), (40, 60))
    cut = Retention(2, hexes(50, 50, None, None))
    target = job(oldest=cut)
    with pytest.raises(st.StaleOffsetError, match="considered stale"):
        follow(spark, target, lambda: change_stream(spark, path, TABLE, max_files=1))
    assert st.load_offset(spark, target.state).batch == 1
    kinds = [("BeginSnapshot", p, 0, 0, None) for p in range(4)] + [("Insert", p, p, p, "s") for p in range(4)]
    snapshot = make_log(spark, kinds + [("CommitSnapshot", p, 0, 0, None) for p in range(4)])
    again = job(oldest=Retention(2, hexes(0, 0, 0, 0)), snapshot_mode="when_needed")
    again.oldest.calls, again.oldest.late = 0, hexes(50, 50, None, None)
    # The start itself meets the cut: a new run begins with a snapshot.
    quiet = replace(again, oldest=None)
    drain(spark, quiet, path, snapshot=snapshot, oldest=spark.range(1).select(vector_literal(hexes(50, 50, None, None)).alias("offsets")))
    first = read_events(spark, target).where("run = 1 AND batch = 0").select("value.op").distinct().collect()
    assert {r["op"] for r in first} == {"r"}


def test_a_cut_off_log_is_met_by_a_new_snapshot_within_one_call(spark, changes, job, tmp_path):
    path = f"{tmp_path}/log"
    append(changes, path, (0, 20), (20, 40), (40, 60))
    kinds = [("BeginSnapshot", p, 0, 0, None) for p in range(4)] + [("Insert", p, p, p, "s") for p in range(4)]
    snapshot = make_log(spark, kinds + [("CommitSnapshot", p, 0, 0, None) for p in range(4)])
    moments = iter([0] * 3 + [1] * 2 + [0] * 99)

    def oldest(spark):
        return spark.range(1).select(vector_literal(hexes(50, 50, 50, 50) if next(moments) else hexes(0, 0, 0, 0)).alias("offsets"))

    target = job(oldest=oldest, snapshot_mode="when_needed")
    follow(spark, target, lambda: change_stream(spark, path, TABLE, max_files=1), lambda: snapshot)
    runs = {r["run"]: r["n"] for r in read_events(spark, target).where("value.op = 'r'").groupBy("run").agg(F.count("seq").alias("n")).collect()}
    assert runs == {0: 4, 1: 4} and st.load_offset(spark, target.state).run == 1


def test_order_and_size_options():
    options = {"topic.prefix": "p", "database.dbname": "d", "database.table": "t"}
    config = CdcConfig.from_options(
        {**options, "max.batch.size": "2048", "max.queue.size": "8192", "max.queue.size.in.bytes": "0", "arrival.order": "hold",
         "arrival.first": "1", "arrival.lag": "9", "notification.enabled.channels": "sink", "notification.sink.topic.name": "n"}
    )
    assert (config.max_batch_size, config.max_queue_size, config.arrival_order, config.arrival_first) == (2048, 8192, "hold", 1)
    assert (config.arrival_lag, config.notification_topic) == (9, "n")
    for bad in ({"arrival.order": "later"}, {"max.batch.size": "-1"}, {"arrival.lag": "-1"}):
        with pytest.raises(ConfigError):
            CdcConfig.from_options({**options, **bad})
