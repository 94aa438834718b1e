"""Streaming queries over tables in several files: the log's files land in any order, and parts of batches may have no event."""

from __future__ import annotations

from dataclasses import replace

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F
from test_operators import CONFIG, TABLE, make_log

import __spark_entry__ as entry
from tidemark.plans import stream_queries
from tidemark.sources.changelog import change_stream
from tidemark.streaming.keyed_log import FileLog
from tidemark.streaming.runner import Capture, read_events, run_cdc

EVENTS, FILES = 240, 4


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """An events table in files whose numbers interleave, as a log of several writers has them."""
    folder = tmp_path_factory.mktemp("tables")
    kinds = ("signup", "click", "view", "error", "purchase", "click")
    rows = [(i, (i * 7) % 29, kinds[i % 6], i / 4, f'{{"k": {i}}}', i) for i in range(EVENTS)]
    frame = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double, props string, s long")
    frame = frame.withColumn("ts", (F.timestamp_seconds(F.lit(1_704_067_200) + F.col("s"))).cast("timestamp_ntz")).drop("s")
    for i in range(FILES):
        frame.where(F.col("event_id") % FILES == i).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def duck(tables):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tables}/events.parquet/*.parquet')")
    yield con
    con.close()


NAMES = [
    "stream_keyed_log",
    "stream_from_offsets",
    "stream_current_state",
    "stream_gaps",
    "stream_shuffled",
    "stream_from_options",
    "stream_cdc_events",
    "stream_resume",
    "stream_retry",
    "stream_event_batches",
    "stream_metrics",
]


@pytest.mark.parametrize("name", NAMES)
def test_a_log_from_several_files_gives_the_rows_of_the_sql(spark, tables, duck, monkeypatch, name):
    # A part of the staged log is several files too, which land in any order.
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 15, raising=False)
    assert difference(spark, duck, entry.queries()[name], entry.oracle_sql()[name], tables) is None


@pytest.mark.parametrize("numbers, expected", [(range(300), 10), ([*range(299), 9_000], 1), (range(40), 2), ([], 1), ([0] * 200, 1)])
def test_all_parts_of_a_log_have_as_many_files(spark, tmp_path, monkeypatch, numbers, expected):
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 10)
    log = spark.createDataFrame([(n,) for n in numbers], "seq long").repartition(3)
    for chunk in range(3):
        assert stream_queries.stage_log(spark, log, f"{tmp_path}/{chunk}", range(chunk, chunk + 1)) == expected
        assert len(list((tmp_path / str(chunk)).glob("part-*"))) == expected
    whole = spark.read.parquet(*[f"{tmp_path}/{chunk}" for chunk in range(3)])
    assert sorted(r["seq"] for r in whole.collect()) == sorted(numbers)


def test_a_batch_without_events_is_sent_to_a_log(spark, tmp_path):
    path, log = f"{tmp_path}/log", FileLog(f"{tmp_path}/messages")
    changes = make_log(spark, [("Insert", 0, 0, 0, "a"), ("CommitTransaction", 0, 0, 0, None), ("Update", 1, 0, 0, "b")])
    for seq in range(3):
        changes.where(F.col("seq") == seq).coalesce(1).write.mode("append").parquet(path)
    job = Capture(replace(CONFIG, snapshot_mode="no_data"), TABLE, f"{tmp_path}/out", f"{tmp_path}/state", ts_ms=F.lit(1).cast("bigint"), log=log)
    run_cdc(spark, job, change_stream(spark, path, TABLE, max_files=1)).awaitTermination()
    assert sorted((r["seq"], r["part"]) for r in log.read(spark).collect()) == [(0, "0:1:0"), (2, "0:3:0")]
    assert sorted(r["seq"] for r in read_events(spark, job).collect()) == [0, 2]
