from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_operators import CONFIG, TABLE, make_log

from tidemark.functions.offsets import vector_literal
from tidemark.operators.state import current_state
from tidemark.plans.pipeline import cdc_events, cdc_records
from tidemark.sources.changelog import change_stream
from tidemark.streaming import start as st
from tidemark.streaming.runner import Capture, read_events, run_cdc
from tidemark.streaming.table import compact_state, manifests, read_state, vacuum_state, write_state_batch


def one():
    return F.lit(1).cast("bigint")



def hexes(*numbers):
    return [None if n is None else format(n, "048x") for n in numbers]


@pytest.fixture(scope="module")
def changes(spark):
    kinds = ("Insert", "Update", "CommitTransaction", "Delete")
    return make_log(spark, [(kinds[i % 4], (i * i) % 4, i, i % 7, f"v{i}") for i in range(60)]).cache()


@pytest.fixture(scope="module")
def snapshot(spark):
    rows = [("BeginSnapshot", p, 0, 0, None) for p in range(4)] + [("Insert", p, p, p, "s") for p in (0, 1, 3)]
    return make_log(spark, rows + [("CommitSnapshot", p, 0, 0, None) for p in range(4)]).cache()


@pytest.fixture
def job(tmp_path):
    def make(**options):
        return Capture(replace(CONFIG, **options), TABLE, f"{tmp_path}/out", f"{tmp_path}/state", ts_ms=one())

    return make


def append(log, path, low, high):
    log.where((F.col("seq") >= low) & (F.col("seq") < high)).coalesce(1).write.mode("append").parquet(path)


def drain(spark, job, path, **options):
    query = run_cdc(spark, job, change_stream(spark, path, TABLE, max_files=1), **options)
    if query is not None:
        query.awaitTermination()


def rows(events):
    return sorted(
        (r["seq"], r["is_tombstone"], r["value"] and r["value"]["op"], r["value"] and tuple(r["value"]["source"]["offsets"]))
        for r in events.collect()
    )


@pytest.mark.parametrize("cut", [0, 17, 59])
def test_stream_equals_batch_wherever_it_is_cut(spark, changes, job, tmp_path, cut):
    target, path = job(snapshot_mode="no_data"), f"{tmp_path}/log"
    append(changes, path, 0, cut)
    drain(spark, target, path)
    append(changes, path, cut, 60)
    drain(spark, target, path)
    batch = cdc_records(cdc_events(changes, TABLE, target.config, ts_ms=one()), target.config)
    assert rows(read_events(spark, target)) == rows(batch)


def test_snapshot_hands_over_without_a_gap(spark, changes, snapshot, job, tmp_path):
    target, path = job(heartbeat_interval_ms=1, notification_channels="sink"), f"{tmp_path}/log"
    append(changes, path, 0, 30)
    append(changes, path, 30, 60)
    drain(spark, target, path, snapshot=snapshot)
    events = read_events(spark, target)
    assert events.where("batch = 0 AND value.op = 'r'").count() == 3
    # Partition 2 had no snapshot row, so it is read from its beginning; the others from their offset.
    starts = [4, 5, -1, 6]
    expected = {
        r["seq"]
        for r in changes.collect()
        if r["Type"] != "CommitTransaction" and r["seq"] > starts[r["PartitionId"]]
    }
    assert {r["seq"] for r in events.where("batch > 0").collect()} == expected
    kept = st.load_offset(spark, target.state)
    assert kept.finished and kept.batch == 2 and None not in [kept.vector[i] for i in (0, 1)]
    assert spark.read.parquet(f"{target.out}/heartbeats").count() == 3
    assert spark.read.parquet(f"{target.out}/notifications").count() == 2


def test_initial_only_takes_the_snapshot_and_stops(spark, changes, snapshot, job, tmp_path):
    target, path = job(snapshot_mode="initial_only"), f"{tmp_path}/log"
    append(changes, path, 0, 60)
    assert run_cdc(spark, target, change_stream(spark, path, TABLE), snapshot) is None
    assert {r["op"] for r in read_events(spark, target).select("value.op").collect()} == {"r"}
    assert run_cdc(spark, target, change_stream(spark, path, TABLE), snapshot) is None
    assert read_events(spark, target).count() == 3


def test_unfinished_snapshot_is_taken_again_in_place(spark, snapshot, job, tmp_path):
    target = job(snapshot_mode="initial_only")
    with pytest.raises(RuntimeError, match="before every partition has committed"):
        run_cdc(spark, target, None, snapshot.where("seq < 9"))
    assert not st.load_offset(spark, target.state).finished
    run_cdc(spark, target, None, snapshot)
    assert read_events(spark, target).count() == 3 and st.load_offset(spark, target.state).finished


def test_starts_from_the_log_tail_without_an_offset(spark, changes, job, tmp_path):
    target, path = job(snapshot_mode="no_data"), f"{tmp_path}/log"
    append(changes, path, 0, 60)
    tails = spark.range(1).select(vector_literal(hexes(50, 50, 50, 50)).alias("offsets"))
    drain(spark, target, path, tails=tails)
    assert min(r["seq"] for r in read_events(spark, target).collect()) == 51


def test_given_offsets_replace_the_stored_ones_on_every_start(spark, changes, job, tmp_path):
    path = f"{tmp_path}/log"
    append(changes, path, 0, 60)
    drain(spark, job(snapshot_mode="no_data"), path)
    again = job(snapshot_mode="no_data", offsets=",".join(hexes(55, 55, 55, 55)))
    drain(spark, again, path)
    second = read_events(spark, again).where("run = 1")
    assert {r["seq"] for r in second.collect()} == {r["seq"] for r in changes.collect() if r["seq"] > 55 and r["Type"] != "CommitTransaction"}


def test_stale_offset_fails_or_is_reset(spark, changes, snapshot, job, tmp_path):
    path = f"{tmp_path}/log"
    append(changes, path, 0, 60)
    drain(spark, job(snapshot_mode="no_data"), path)
    oldest = spark.range(1).select(vector_literal(hexes(90, None, None, None)).alias("offsets"))
    with pytest.raises(st.StaleOffsetError, match="considered stale"):
        drain(spark, job(), path, oldest=oldest)
    target = job(snapshot_mode="when_needed")
    drain(spark, target, path, oldest=oldest, snapshot=snapshot)
    assert {r["op"] for r in read_events(spark, target).where("run = 1 AND batch = 0").select("value.op").collect()} == {"r"}


@pytest.mark.parametrize(
    "mode, stored, finished, stale, config, all_null, expected",
    [
        ("initial", True, True, False, False, False, (False, True, "stored", False)),
        ("no_data", True, True, False, False, False, (False, True, "stored", False)),
        ("initial_only", True, True, False, False, False, (False, False, "stored", False)),
        ("initial", True, True, False, True, False, (False, True, "config", False)),
        ("when_needed", True, True, True, False, False, (True, True, "none", False)),
        ("initial", True, True, True, False, False, (False, True, "stored", True)),
        ("initial_only", True, True, True, False, False, (False, False, "stored", False)),
        ("initial", True, False, False, False, False, (True, True, "stored", False)),
        ("initial_only", True, False, False, False, False, (True, False, "stored", False)),
        ("initial", False, False, False, False, True, (True, True, "none", False)),
        ("initial_only", False, False, False, False, True, (True, False, "none", False)),
        ("no_data", False, False, False, True, True, (False, True, "config", False)),
        ("no_data", False, False, False, False, True, (False, True, "tails", False)),
        (" WHEN_NEEDED ", False, False, False, False, True, (True, True, "none", False)),
        ("bogus", False, False, False, False, True, (True, True, "none", False)),
    ],
)
def test_start_decision(spark, mode, stored, finished, stale, config, all_null, expected):
    facts = [F.lit(v) for v in (mode, stored, finished, stale, config, all_null)]
    row = spark.range(1).select(st.start_decision(*facts).alias("d")).first()["d"]
    assert (row["snapshot"], row["stream"], row["start"], row["fail"]) == expected


@pytest.mark.parametrize("snapshot, completed", [(True, False), (False, True), (True, True)])
def test_offset_round_trip(spark, tmp_path, snapshot, completed):
    offset = st.Offset(["1", "10", None, "2"], "3", 1, snapshot, completed, run=2, batch=7)
    st.save_offset(spark, str(tmp_path), replace(offset, batch=6))
    st.save_offset(spark, str(tmp_path), offset)
    assert st.load_offset(spark, str(tmp_path)) == offset
    assert st.load_offset(spark, str(tmp_path), 2, 6) == replace(offset, batch=6)
    assert st.load_offset(spark, str(tmp_path / "none")) is None
    stored = spark.read.parquet(f"{tmp_path}/offsets").where("run = 2 AND batch = 7").first()
    assert stored["offsets"] == "1,10,null,2" and stored["snapshot"] == (True if snapshot else None)


def test_state_table_goes_on_after_a_new_checkpoint(spark, changes, tmp_path):
    events = cdc_events(changes, TABLE, CONFIG, ts_ms=one()).select("key", "seq", "op", "after")
    path = f"{tmp_path}/table"
    for run, batch, low in ((0, 0, 0), (0, 1, 15), (1, 0, 30), (1, 1, 45)):
        write_state_batch(events.where((F.col("seq") >= low) & (F.col("seq") < low + 15)), path, batch, run)
        if batch == 1:
            compact_state(spark, path)
    found = sorted((r["key"]["a"], r["seq"]) for r in read_state(spark, path).collect())
    assert found == sorted((r["key"]["a"], r["seq"]) for r in current_state(events).collect())


def test_state_table(spark, changes, tmp_path):
    events = cdc_events(changes, TABLE, CONFIG, ts_ms=one()).select("key", "seq", "op", "after")
    path = f"{tmp_path}/table"
    assert read_state(spark, path) is None
    for batch in range(4):
        part = events.where((F.col("seq") >= batch * 15) & (F.col("seq") < (batch + 1) * 15))
        write_state_batch(part, path, batch)
        write_state_batch(part, path, batch)
        if batch in (1, 2):
            compact_state(spark, path)
            compact_state(spark, path)
    found = sorted((r["key"]["a"], r["seq"], r["after"]["b"]) for r in read_state(spark, path).collect())
    expected = sorted((r["key"]["a"], r["seq"], r["after"]["b"]) for r in current_state(events).collect())
    assert found == expected and found


def _events(spark, rows):
    """``key, seq, op, after`` from (key, seq, op)."""
    frame = spark.createDataFrame(rows, "k long, seq long, op string")
    return frame.select(F.struct(F.col("k").alias("a")).alias("key"), "seq", "op", F.struct(F.col("seq").alias("b")).alias("after"))


def _state(frame):
    return sorted((r["key"]["a"], r["seq"]) for r in frame.collect())


def test_compaction_rewrites_only_the_buckets_a_batch_touched(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_state_batch(_events(spark, [(k, k, "c") for k in range(2000)]), path, 0)
    assert len(compact_state(spark, path, buckets=200, moment=0)) == 200
    write_state_batch(_events(spark, [(7, 5000, "u"), (8, 5001, "d")]), path, 1)
    touched = compact_state(spark, path, moment=10)
    assert len(touched) <= 2
    written = {p.name: len([b for b in p.iterdir() if b.is_dir()]) for p in (tmp_path / "table" / "base").iterdir() if p.is_dir()}
    assert written["version=1"] == 200 and written["version=2"] <= 2
    expected = sorted([(k, k) for k in range(2000) if k not in (7, 8)] + [(7, 5000)])
    assert _state(read_state(spark, path)) == expected
    assert compact_state(spark, path) == []


def test_readers_of_some_keys_open_their_buckets_alone(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_state_batch(_events(spark, [(k, k, "c") for k in range(1000)]), path, 0)
    compact_state(spark, path, buckets=100)
    write_state_batch(_events(spark, [(3, 2000, "u"), (4, 2001, "d"), (1234, 2002, "c")]), path, 1)
    keys = spark.createDataFrame([(3,), (4,), (5,), (1234,), (9999,)], "k long").select(F.struct(F.col("k").alias("a")).alias("key"))
    found = read_state(spark, path, keys)
    assert _state(found) == [(3, 2000), (5, 5), (1234, 2002)]
    opened = [f for f in found.inputFiles() if "/base/" in f]
    assert 1 <= len(opened) <= 5


def test_batches_and_versions_go_after_a_grace_period(spark, tmp_path):
    path = f"{tmp_path}/table"
    for batch in range(3):
        write_state_batch(_events(spark, [(k, batch * 100 + k, "c") for k in range(30)]), path, batch)
        compact_state(spark, path, buckets=4, moment=batch * 1000)
    write_state_batch(_events(spark, [(1, 999, "u")]), path, 3)
    before = _state(read_state(spark, path))
    assert vacuum_state(spark, path, grace_ms=5000, now=2500) == []
    # Of the manifests at 0, 1000 and 2000 the second is the oldest that a reader may hold.
    gone = vacuum_state(spark, path, grace_ms=1000, now=2500)
    assert sorted(g.split("/table/")[1] for g in gone) == [
        "base/version=1", "delta/run=0/batch=0/part=0", "delta/run=0/batch=1/part=0"
    ]
    assert _state(read_state(spark, path)) == before and before[1] == (1, 999)
    assert len(manifests(spark, path)) == 3 and vacuum_state(spark, f"{tmp_path}/none", 0) == []


def test_a_table_whose_keys_are_all_deleted_is_empty(spark, tmp_path):
    path = f"{tmp_path}/table"
    write_state_batch(_events(spark, [(1, 1, "c"), (2, 2, "c")]), path, 0)
    compact_state(spark, path)
    write_state_batch(_events(spark, [(1, 3, "d"), (2, 4, "d")]), path, 1)
    compact_state(spark, path)
    assert read_state(spark, path).count() == 0
    write_state_batch(_events(spark, [(2, 5, "c")]), path, 2)
    assert _state(read_state(spark, path)) == [(2, 5)]
