from __future__ import annotations

import decimal
import json
import random
from dataclasses import replace

import pytest
from pyspark.sql import Observation, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.config import CdcConfig
from tidemark.functions import events as fe
from tidemark.hooks import Hooks
from tidemark.logschema import raw_log_schema
from tidemark.operators import columns as oc
from tidemark.operators import envelope as oe
from tidemark.operators import metrics as om
from tidemark.operators import sinks as os_
from tidemark.operators import snapshot as osn
from tidemark.operators import state as ost
from tidemark.operators.offsets import begin_at
from tidemark.operators.sinks import keyed_order
from tidemark.plans.pipeline import cdc_events, cdc_records, rejected_records
from tidemark.sources import catalog
from tidemark.sources.changelog import parse_records
from tidemark.sources.observe import observe, table_filter

CONFIG = CdcConfig(topic_prefix="p", db="db", table="t", partitions=4)
TABLE = StructType(
    [
        StructField("a", LongType(), False, {"type": "BIGINT", "primary_key": True}),
        StructField("b", StringType(), True, {"type": "TEXT"}),
    ]
)
KEYLESS = StructType([StructField("a", LongType(), True, {"type": "BIGINT"}), StructField("b", StringType(), True, {"type": "TEXT"})])


def make_log(spark, rows, table=TABLE):
    """Rows ``(kind, partition, internal id, *values)`` in arrival order."""
    data = [
        (i, i.to_bytes(24, "big"), pid, kind, "t", i.to_bytes(40, "big"), "1", iid.to_bytes(12, "big"), *values)
        for i, (kind, pid, iid, *values) in enumerate(rows)
    ]
    return spark.createDataFrame(data, raw_log_schema(table))


def ops(df):
    return [(r["op"], r["key"][0]) for r in df.orderBy("seq").collect()]


def test_insert_delete_insert_update(spark):
    log = make_log(
        spark,
        [("BeginTransaction", 0, 0, 0, None), ("Insert", 0, 9, 3, "x"), ("CommitTransaction", 0, 0, 0, None)]
        + [("Delete", 0, 9, 3, None), ("Insert", 0, 9, 3, "y"), ("Update", 0, 9, 3, "z")],
    )
    config = replace(CONFIG, tombstones=False)
    events = cdc_events(log, TABLE, config, ts_ms=F.lit(1).cast("bigint"))
    assert ops(events) == [("c", 3), ("d", 3), ("c", 3), ("u", 3)]
    rows = events.orderBy("seq").collect()
    assert [r["after"] and r["after"]["b"] for r in rows] == ["x", None, "y", "z"]
    assert all(r["before"] is None for r in rows)
    assert {r["source"]["snapshot"] for r in rows} == {"false"}
    assert cdc_records(events, config).count() == 4


def test_keyless_events_share_the_internal_id(spark):
    log = make_log(spark, [("Insert", 0, 1, 5, "a"), ("Insert", 1, 2, 5, "b"), ("Delete", 0, 1, 5, None)], KEYLESS)
    events = cdc_events(log, KEYLESS, replace(CONFIG, populate_internal_id=True), ts_ms=F.lit(1).cast("bigint"))
    records = cdc_records(events, CONFIG).orderBy("seq", "is_tombstone").collect()
    assert [r["value"] and r["value"]["op"] for r in records] == ["c", "c", "d", None]
    assert [r["key"]["internalId"][-2:] for r in records] == ["01", "02", "01", "01"]
    after = records[0]["value"]["after"]
    assert list(after.asDict()) == ["a", "b", "internalId"] and after["internalId"] == records[0]["key"]["internalId"]


def test_skipped_operations_still_move_the_vector(spark):
    log = make_log(spark, [("Insert", i % 2, i, i, "a") for i in range(4)] + [("Delete", 2, 1, 1, None), ("Update", 2, 2, 2, "b")])
    events = cdc_events(log, TABLE, replace(CONFIG, skipped_operations="c"), ts_ms=F.lit(1).cast("bigint"))
    assert ops(events) == [("d", 1), ("u", 2)]
    first = events.orderBy("seq").first()["source"]["offsets"]
    assert [o and int(o, 16) for o in first] == [2, 3, 4, None]
    everything = cdc_events(log, TABLE, replace(CONFIG, skipped_operations="none"), ts_ms=F.lit(1).cast("bigint"))
    assert everything.count() == 6


def test_key_keeps_columns_that_the_row_leaves_out(spark):
    pk = StructType([replace_meta(TABLE["a"]), replace_meta(TABLE["b"], primary_key=True)])
    log = make_log(spark, [("Insert", 0, 1, 5, "x")], pk)
    row = cdc_events(log, pk, replace(CONFIG, column_include="db.t.a"), ts_ms=F.lit(1).cast("bigint")).first()
    assert row["key"].asDict() == {"a": 5, "b": "x"} and row["after"].asDict() == {"a": 5}
    row = cdc_events(log, pk, replace(CONFIG, column_exclude="db[.]t[.](a|zz)"), ts_ms=F.lit(1).cast("bigint")).first()
    assert row["after"].asDict() == {"b": "x"}


def replace_meta(f, **facts):
    return StructField(f.name, f.dataType, f.nullable, {**f.metadata, **facts})


def test_masks_apply_to_the_row_and_not_to_the_key(spark):
    pk = StructType([TABLE["a"], replace_meta(TABLE["b"], primary_key=True)])
    log = make_log(spark, [("Insert", 0, 1, 5, "secret")], pk)
    config = replace(CONFIG, mask_chars={10: "db.t.b,db.t.a"})
    row = cdc_events(log, pk, config, ts_ms=F.lit(1).cast("bigint")).first()
    assert row["key"]["b"] == "secret" and row["after"].asDict() == {"a": 5, "b": "*" * 10}


def test_partition_out_of_range_raises(spark):
    log = make_log(spark, [("Insert", 7, 1, 5, "x")])
    with pytest.raises(Exception, match="PartitionId must be in 0..3"):
        cdc_events(log, TABLE, CONFIG, ts_ms=F.lit(1).cast("bigint")).collect()


def test_failure_modes_of_the_pipeline(spark):
    table = StructType([TABLE["a"], StructField("b", StringType(), True, {"type": "TIME"})])
    log = make_log(spark, [("Insert", 0, 1, 1, "01:00:00"), ("Insert", 0, 2, 2, "soon"), ("Update", 0, 1, 1, None)], table)
    with pytest.raises(Exception, match="cannot convert the record at"):
        cdc_events(log, table, CONFIG).collect()
    for mode in ("warn", "ignore"):
        config = replace(CONFIG, failure_mode=mode)
        events = cdc_events(log, table, config, ts_ms=F.lit(1).cast("bigint"))
        assert [r["after"]["b"] for r in events.orderBy("seq").collect()] == [3600000, None]
        assert [r["seq"] for r in rejected_records(log, table, config).collect()] == [1]


def test_only_columns_that_stay_and_convert_here_are_judged(spark):
    table = StructType([TABLE["a"], StructField("b", StringType(), True, {"type": "TIME"})])
    log = make_log(spark, [("Insert", 0, 1, 1, "soon"), ("Insert", 0, 2, 2, "01:00:00")], table)
    moment = F.lit(1).cast("bigint")
    assert cdc_events(log, table, replace(CONFIG, column_exclude="db.t.b"), ts_ms=moment).count() == 2
    hooks = Hooks(converters={r".*\.b": F.upper})
    assert {r["after"]["b"] for r in cdc_events(log, table, CONFIG, ts_ms=moment, hooks=hooks).collect()} == {"SOON", "01:00:00"}


@pytest.mark.parametrize(
    ("kind", "good", "bad"), [("YEAR", "1999", "x"), ("INT", "7", "3000000000"), ("DECIMAL(4,1)", "1.5", "99999"), ("DATE", "2020-01-01", "soon")]
)
def test_failure_modes_of_plain_conversions(spark, kind, good, bad):
    table = StructType([TABLE["a"], StructField("b", StringType(), True, {"type": kind})])
    log = make_log(spark, [("Insert", 0, 1, 1, good), ("Insert", 0, 2, 2, bad), ("Update", 0, 1, 1, None)], table)
    config = replace(CONFIG, failure_mode="warn")
    events = cdc_events(log, table, config, ts_ms=F.lit(1).cast("bigint")).collect()
    assert sorted(r["seq"] for r in events) == [0, 2]
    assert [r["seq"] for r in rejected_records(log, table, config).collect()] == [1]
    with pytest.raises(Exception, match="cannot convert the record at"):
        cdc_events(log, table, CONFIG).collect()


def test_masks_leave_raw_text_of_other_types_alone(spark):
    table = StructType([TABLE["a"], StructField("b", StringType(), True, {"type": "TIME"})])
    log = make_log(spark, [("Insert", 0, 1, 1, "01:00:00")], table)
    config = replace(CONFIG, mask_chars={3: "db.t.b"})
    assert cdc_events(log, table, config, ts_ms=F.lit(1).cast("bigint")).first()["after"]["b"] == 3600000


def test_keyed_messages_are_in_order_within_one_task(spark):
    rows = [("t", f"k{i % 7}", i, j == 1) for i in range(300) for j in (0, 1)]
    frame = spark.createDataFrame(rows, "topic string, key string, seq long, is_tombstone boolean").repartition(5, "seq")
    placed = keyed_order(frame).withColumn("task", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()).collect()
    by_key = {}
    for r in sorted(placed, key=lambda r: r["place"]):
        by_key.setdefault(r["key"], []).append((r["task"], r["seq"], r["is_tombstone"]))
    for own in by_key.values():
        assert len({task for task, *_ in own}) == 1 and [o[1:] for o in own] == sorted(o[1:] for o in own)


@pytest.mark.parametrize("width", [2, 65])
def test_begin_at_keeps_unknown_partitions_at_any_width(spark, width):
    rows = [(p, bytes([n])) for p in (None, -1, 0, 1, 99) for n in (1, 3)]
    log = spark.createDataFrame(rows, "PartitionId int, Offset binary")
    start = ["02"] * width
    kept = sorted((str(r[0]), r[1][0]) for r in begin_at(log, start).collect())
    frame = spark.createDataFrame([(start,)], "offsets array<string>")
    assert kept == sorted((str(r[0]), r[1][0]) for r in begin_at(log, frame).collect())
    assert kept == sorted([("None", 1), ("None", 3), ("-1", 1), ("-1", 3), ("0", 3), ("1", 3), ("99", 1), ("99", 3)])


def test_failure_mode_operator(spark):
    rows = spark.createDataFrame([("1",), ("x",), (None,)], "t string")
    attempt = {"n": (F.col("t"), F.col("t").try_cast("int"))}
    good, bad = oe.failure_mode(rows, attempt, "warn")
    assert good.count() == 2 and bad.collect()[0]["t"] == "x"
    good, bad = oe.failure_mode(rows, attempt, "ignore")
    assert good.count() == 2 and bad.count() == 0
    with pytest.raises(Exception, match="cannot convert n: x"):
        oe.failure_mode(rows, attempt, "fail")[0].count()


def test_drop_empty_is_off_unless_asked(spark):
    log = make_log(spark, [("Insert", 0, 1, 1, "a"), ("Delete", 0, 1, 1, None)])
    events = cdc_events(log, TABLE, CONFIG)
    assert oe.drop_empty(events).count() == 2 and oe.drop_empty(events, True).count() == 1
    assert oe.drop_unchanged_updates(events).count() == 2


def test_source_facts(spark):
    event = cdc_events(make_log(spark, [("Insert", 1, 1, 1, "a")]), TABLE, CONFIG, ts_ms=F.lit(1543602924000).cast("bigint"))
    row = event.select(
        F.unix_millis(fe.event_timestamp()).alias("ms"), fe.event_txid().alias("tx"), fe.event_position().alias("at")
    ).first()
    assert row["ms"] == 1543602924000 and len(row["tx"]) == 80
    assert row["at"] == f"null,{'0' * 48},null,null"
    none = spark.range(1).select(F.lit(None).cast(event.schema["source"].dataType).alias("source"))
    assert none.select(fe.event_position().alias("at"), fe.event_txid().alias("tx")).first() == (None, None)


def test_processing_time_is_used_when_no_time_is_given(spark):
    row = cdc_events(make_log(spark, [("Insert", 1, 1, 1, "a")]), TABLE, CONFIG).first()
    assert row["ts_ms"] == row["source"]["ts_ms"] > 1_600_000_000_000


def test_propagated_types(spark):
    table = StructType(
        [
            StructField("name", StringType(), False, {"type": "VARCHAR(255)", "length": 255}),
            StructField("age", LongType(), True, {"type": "INT", "length": 10, "scale": 0}),
        ]
    )
    everything = oc.propagated(table, replace(CONFIG, propagate_columns=".*"))
    assert everything["name"] == {"source.column.type": "VARCHAR", "source.column.length": "255", "source.column.name": "name"}
    assert everything["age"]["source.column.scale"] == "0"
    by_type = oc.propagated(table, replace(CONFIG, propagate_types=r".+\.VARCHAR,.+\.DECIMAL"))
    assert list(by_type) == ["name"]
    frame = oc.propagate_type(spark.createDataFrame([("a", 1)], "name string, age bigint"), table, replace(CONFIG, propagate_columns=".*"))
    assert frame.schema["age"].metadata["source.column.type"] == "INT"
    field = os_.message_schema(frame.schema, False)["fields"][0]
    assert field["parameters"]["source.column.length"] == "255"


def test_topics(spark):
    row = spark.range(1).select(
        os_.topic_name("prefix", "db", "product", "_").alias("a"),
        os_.topic_name("my_topic", "db", "product", strategy="unicode").alias("b"),
    ).first()
    assert row["a"] == "prefix_db_product" and row["b"] == "my_u005ftopic.db.product"


def test_messages_carry_their_schema(spark):
    events = cdc_events(make_log(spark, [("Insert", 0, 1, 33, "a"), ("Delete", 0, 1, 33, None)]), TABLE, CONFIG)
    rows = os_.to_messages(cdc_records(events, CONFIG), "p.db.t", TABLE).orderBy("seq", "is_tombstone").collect()
    key, value = json.loads(rows[0]["key"]), json.loads(rows[0]["value"])
    assert key["payload"] == {"a": 33}
    assert key["schema"]["fields"] == [{"type": "int64", "optional": False, "field": "a"}]
    after = value["schema"]["fields"][1]
    assert [(f["field"], f["optional"]) for f in after["fields"]] == [("a", False), ("b", True)]
    assert value["payload"]["transaction"] is None
    assert value["payload"]["after"] == {"a": 33, "b": "a"} and value["payload"]["before"] is None
    assert [f["field"] for f in value["schema"]["fields"]] == [
        "before",
        "after",
        "source",
        "op",
        "ts_ms",
        "transaction",
    ]
    assert rows[2]["value"] is None and rows[2]["key"] == rows[1]["key"]


@pytest.mark.parametrize("precision, scale", [(5, 0), (18, 4), (19, 0), (38, 0), (38, 38), (30, 4)])
def test_decimals_in_messages_are_their_unscaled_bytes(spark, precision, scale):
    rng = random.Random(precision + scale)
    top = 10**precision - 1
    numbers = {0, 1, -1, 127, 128, -128, -129, 255, 256, 32767, -32768, top, -top, *[rng.randint(-top, top) for _ in range(50)]}
    numbers |= {s * (1 << b) + d for b in (15, 31, 32, 63, 64, 95, 96) for s in (1, -1) for d in (-1, 0, 1)}
    numbers = sorted(n for n in numbers if abs(n) <= top)
    rows = [(i, decimal.Decimal(n).scaleb(-scale, decimal.Context(prec=60))) for i, n in enumerate(numbers)]
    frame = spark.createDataFrame(rows, f"i int, d decimal({precision},{scale})")
    kind = frame.schema["d"].dataType
    found = {r["i"]: bytes(r["b"]) for r in frame.select("i", os_.unscaled_bytes(F.col("d"), kind).alias("b")).collect()}
    for i, n in enumerate(numbers):
        size = next(k for k in range(1, 18) if -(1 << 8 * k - 1) <= n < 1 << 8 * k - 1)
        assert found[i] == n.to_bytes(size, "big", signed=True), n


def test_payloads_fit_their_schema_at_any_depth(spark):
    row = "struct<d: decimal(9,2), day: date, moment: timestamp, local: timestamp_ntz>"
    one = "'d', 1.25BD, 'day', date'1970-01-03', 'moment', timestamp'1970-01-01 00:00:01.5', 'local', timestamp_ntz'1970-01-01 00:00:02'"
    two = "'d', -0.01BD, 'day', date'1969-12-31', 'moment', CAST(NULL AS timestamp), 'local', CAST(NULL AS timestamp_ntz)"
    frame = spark.sql(
        f"SELECT struct(1L AS k) AS key, CAST(named_struct('one', named_struct({one}), 'more', array(named_struct({two})))"
        f" AS struct<one: {row}, more: array<{row}>>) AS value"
    )
    value = os_.payload_value(F.col("value"), frame.schema["value"].dataType)
    payload = json.loads(frame.select(F.to_json(value, {"ignoreNullFields": "false"}).alias("v")).first()["v"])
    assert payload == {
        "one": {"d": "fQ==", "day": 2, "moment": 1500, "local": 2000},
        "more": [{"d": "/w==", "day": -1, "moment": None, "local": None}],
    }
    schema = os_.message_schema(frame.schema["value"].dataType, False)
    fields = {f["field"]: f for f in schema["fields"][0]["fields"]}
    assert fields["d"]["parameters"] == {"scale": "2", "connect.decimal.precision": "9"} and fields["d"]["type"] == "bytes"
    assert [fields[n]["name"].rsplit(".", 1)[1] for n in ("d", "day", "moment", "local")] == ["Decimal", "Date", "Timestamp", "Timestamp"]
    assert os_.payload_value(F.lit(1), StringType()) is not None


def test_propagated_types_reach_the_message(spark):
    table = StructType([TABLE["a"], replace_meta(TABLE["b"], type="VARCHAR(20)", length=20)])
    config = replace(CONFIG, propagate_types=".*VARCHAR")
    events = cdc_events(make_log(spark, [("Insert", 0, 1, 33, "a")], table), table, config)
    value = json.loads(os_.to_messages(events, "p.db.t", table).first()["value"])
    a, b = value["schema"]["fields"][1]["fields"]
    assert "parameters" not in a
    assert b["parameters"] == {"source.column.type": "VARCHAR", "source.column.length": "20", "source.column.name": "b"}


def test_written_events_are_in_order(spark, tmp_path):
    log = make_log(spark, [("Insert" if i % 3 else "Delete", i % 4, i, i % 5, "v") for i in range(200)])
    records = cdc_records(cdc_events(log, TABLE, replace(CONFIG, bucket_rows=16)), CONFIG)
    os_.write_events(records, str(tmp_path / "a"), total_order=True)
    os_.write_events(records, str(tmp_path / "b"))
    for part in ("a", "b"):
        read = spark.read.parquet(str(tmp_path / part))
        assert read.count() == records.count() and [r[0] for r in read.select("topic").distinct().collect()] == ["p.db.t"]
        per_file = read.select("seq", F.input_file_name().alias("f")).groupBy("f").agg(F.collect_list("seq").alias("s"))
        assert all(r["s"] == sorted(r["s"]) for r in per_file.collect())


def test_snapshot_commits_end_their_partition(spark):
    kinds = [("BeginSnapshot", 0), ("Insert", 0), ("Insert", 1), ("CommitSnapshot", 0), ("Insert", 0), ("Update", 1)]
    kinds += [("CommitSnapshot", 1), ("Insert", 1), ("CommitSnapshot", 0), ("Insert", 0)]
    log = make_log(spark, [(k, p, 1, i, None) for i, (k, p) in enumerate(kinds)])
    assert [r["seq"] for r in osn.snapshot_rows(log, 2).orderBy("seq").collect()] == [1, 2, 5]
    assert osn.snapshot_complete(log, 2).first()["completed"] and not osn.snapshot_complete(log, 3).first()["completed"]
    # Partition 1 has not committed in the first six records: it passes whole.
    assert [r["seq"] for r in osn.snapshot_rows(log.where("seq < 6"), 2).orderBy("seq").collect()] == [1, 2, 5]
    progress = osn.snapshot_progress(log.where("seq < 6"), 2).first()
    assert (progress["rows_scanned"], progress["partitions_committed"], progress["completed"]) == (3, 1, False)
    times = log.withColumn("ts_ms", F.col("seq"))
    assert [tuple(r)[1:] for r in osn.snapshot_notifications(times, 1).collect()] == [("STARTED", 0), ("COMPLETED", 6)]
    assert [r["type"] for r in osn.snapshot_notifications(times, 3).collect()] == ["STARTED"]
    assert osn.snapshot_notifications(times, 2, None).count() == 0


def test_snapshot_events(spark):
    rows = [("BeginSnapshot", 0, 0, 0, None), ("Insert", 0, 1, 1, "a"), ("Insert", 1, 2, 2, "b"), ("CommitSnapshot", 0, 0, 0, None), ("CommitSnapshot", 1, 0, 0, None)]
    events = cdc_events(make_log(spark, rows), TABLE, CONFIG, snapshot=True).orderBy("seq").collect()
    assert [(r["op"], r["source"]["snapshot"]) for r in events] == [("r", "first"), ("r", "true")]


def test_snapshot_rows_are_filtered_without_a_join(spark, capsys):
    osn.snapshot_rows(make_log(spark, [("Insert", 0, 1, 1, "a")]), 2).explain()
    plan = capsys.readouterr().out.split("Subquery")[0]
    assert "Join" not in plan and "Exchange" not in plan


def test_current_state_folds_a_hot_key_before_the_shuffle(spark):
    rows = [("Update", 0, 1, 1 if i % 3 == 0 else i, f"v{i}") for i in range(300)] + [("Delete", 0, 1, 299, None)]
    events = cdc_events(make_log(spark, rows), TABLE, CONFIG)
    state = {r["key"]["a"]: r["after"]["b"] for r in ost.current_state(events.select("seq", "key", "op", "after")).collect()}
    expected = {}
    for i, (kind, _, _, key, value) in enumerate(rows):
        expected.pop(key, None) if kind == "Delete" else expected.__setitem__(key, value)
    assert state == expected


def test_counters_and_tags(spark):
    rows = [("Update", 0, 1, 1, "a"), ("Delete", 0, 1, 1, None), ("Insert", 0, 1, 1, "a"), ("Insert", 0, 2, 2, "a")]
    events = cdc_events(make_log(spark, rows), TABLE, CONFIG)
    counted = om.metric_tags(om.event_counters(events), "env=prod,bu=x").first()
    assert tuple(counted)[:4] == (4, 2, 1, 1) and counted["tags"] == {"env": "prod", "bu": "x"}
    assert om.metric_tags(om.event_counters(events), None).first()["tags"] == {}
    seen = Observation("events")
    om.observe_counters(events, seen).count()
    assert seen.get["total_creates"] == 2


def test_heartbeats_off(spark):
    rows = spark.createDataFrame([(1, ["a"], 5)], "seq bigint, offsets array<string>, ts_ms bigint")
    assert om.heartbeats(rows, 0, "hb", "p").count() == 0
    assert tuple(om.heartbeats(rows, 10, "hb", "p").first()) == ("hb.p", 10, "a")


def test_hooks(spark):
    hooks = Hooks(
        converters={"db.t.b": lambda c: F.concat(c, F.lit("!"))},
        post_processors=[lambda df: df.withColumn("op", F.upper("op"))],
        topic=lambda config: F.lit("mine"),
        source=lambda s: F.struct(s["db"].alias("db")),
    )
    row = cdc_events(make_log(spark, [("Insert", 0, 1, 1, "a")]), TABLE, CONFIG, hooks=hooks).first()
    assert (row["after"]["b"], row["op"], row["topic"], row["source"].asDict()) == ("a!", "C", "mine", {"db": "db"})


def test_observe_clauses(spark, tmp_path):
    log = make_log(spark, [("Insert", i % 2, i, i, "x") for i in range(10)])
    out = observe(log, ["a"], ["t"], begin_at_offsets=[format(3, "048x"), None], where="a < 8")
    assert [r["a"] for r in out.orderBy("a").collect()] == [1, 3, 4, 5, 6, 7] and "b" not in out.columns
    assert observe(log, tables=["other"]).count() == 0
    kept = observe(log, ["a"], fmt="json", into=str(tmp_path / "out"))
    assert kept.count() == 10 and json.loads(kept.first()["record"])["Type"] == "Insert"
    assert sorted(observe(log, into=str(tmp_path / "sql")).collect()) == sorted(log.collect())
    with pytest.raises(ValueError):
        observe(log, fmt="xml")


def test_table_filter(spark):
    rows = [("db", "t"), ("DB", "t"), ("db", "T"), (None, "t"), ("cluster", "t"), ("Information_Schema", "t")]
    frame = spark.createDataFrame(rows, "db string, Table string")
    assert [tuple(r) for r in table_filter(frame, "db", "t").collect()] == [("db", "t")]
    assert table_filter(frame, "Information_Schema", "t").count() == 0


def test_messages_of_a_log_are_read_back(spark):
    log = make_log(spark, [("Insert", 0, 1, 1, "a")])
    sent = log.select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    assert parse_records(sent, TABLE).collect() == log.collect()


def test_table_schema(spark):
    columns = spark.createDataFrame(
        [
            ("id", "INT", 1, True, True, None, 10),
            ("salary", "DECIMAL(5,2)", 2, False, False, "1", 5),
            ("wide", "DECIMAL(65,30)", 3, False, False, None, 65),
            ("vec", "VECTOR(3, F32)", 4, False, False, None, None),
        ],
        "column_name string, type_name string, position int, primary_key boolean, auto_increment boolean, default string, length int",
    )
    table = catalog.table_schema(columns)
    assert table.names == ["id", "salary", "wide", "vec"] and catalog.primary_key(table) == ["id"]
    assert table["id"].metadata["type"] == "BIGINT" and not table["id"].nullable
    assert [f.dataType.simpleString() for f in table.fields] == ["bigint", "decimal(5,2)", "string", "array<float>"]
    assert table["salary"].metadata["default"] == "1"


def test_partition_count(spark):
    def count(rows):
        return catalog.partition_count(spark.createDataFrame(rows, "num_partitions int")).first()["partitions"]

    assert count([(8,)]) == 8 and count([]) == 1 and count([(None,)]) == 1
    with pytest.raises(Exception, match="at least 1"):
        count([(0,)])
