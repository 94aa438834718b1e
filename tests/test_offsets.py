from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import offsets as fo
from tidemark.operators import offsets as oo


def make_log(spark, rows):
    """``(seq, partition)`` pairs as a log with byte offsets that follow ``seq``."""
    frame = spark.createDataFrame(rows, "seq bigint, PartitionId int")
    return frame.withColumn("Offset", F.unhex(F.lpad(F.hex("seq"), 8, "0")))


def brute_force(rows, n, start=None):
    vector, out = list(start or [None] * n), {}
    for seq, pid in sorted(rows):
        vector[pid] = format(seq, "08x")
        out[seq] = list(vector)
    return out


def as_dict(df):
    return {r["seq"]: r["offsets"] for r in df.select("seq", "offsets").collect()}


@pytest.fixture(scope="module")
def rows():
    # Gaps, and one partition with more than a third of all records.
    rng = random.Random(5)
    seqs = rng.sample(range(3000), 900)
    return [(s, 2 if rng.random() < 0.5 else rng.randrange(5)) for s in seqs]


@pytest.mark.parametrize("levels", [1, 2, 3])
@pytest.mark.parametrize("bucket_rows, fanout", [(7, 3), (100, 4), (1 << 18, 1 << 10)])
def test_vector_equals_brute_force(spark, rows, levels, bucket_rows, fanout):
    out = oo.with_offset_vector(make_log(spark, rows), 5, levels=levels, bucket_rows=bucket_rows, fanout=fanout)
    assert as_dict(out) == brute_force(rows, 5)


@pytest.mark.parametrize("bucket_rows, fanout", [(7, 3), (1000, 2), (4000, 2)])
def test_vector_with_known_span_and_start(spark, rows, bucket_rows, fanout):
    start = ["0a", None, None, "ff", None]
    span = (min(rows)[0], max(rows)[0])
    out = oo.with_offset_vector(
        make_log(spark, rows), 5, start, span=span, bucket_rows=bucket_rows, fanout=fanout
    )
    assert as_dict(out) == brute_force(rows, 5, start)


def test_known_span_of_one_bucket_needs_no_carry(spark, rows, capsys):
    log = make_log(spark, rows)
    oo.with_offset_vector(log, 5, span=(0, 2999)).explain()
    assert "Join" not in capsys.readouterr().out
    assert as_dict(oo.with_offset_vector(log, 5, span=(0, 2999))) == brute_force(rows, 5)


@pytest.mark.parametrize("n, levels, bucket_rows, fanout", [(20, 2, 37, 3), (64, 1, 50, 100), (256, 2, 200, 4), (64, 2, 100_000, 4)])
def test_wide_vector_equals_the_global_window(spark, n, levels, bucket_rows, fanout):
    rng = random.Random(n)
    places = [None, -1, n, *range(n)]
    rows = [(s, rng.choice(places), s.to_bytes(3, "big", signed=True) if s % 11 else None) for s in rng.sample(range(-50, 3000), 500)]
    log = spark.createDataFrame(rows, "seq long, PartitionId int, Offset binary")
    start = [None if i % 3 else f"{i:04x}" for i in range(n)]
    found = oo.with_offset_vector(log, n, start, levels=levels, bucket_rows=bucket_rows, fanout=fanout)
    assert as_dict(found) == as_dict(oo.global_offset_vector(log, n, start))
    span = (min(rows)[0], max(rows)[0])
    assert as_dict(oo.with_offset_vector(log, n, start, span=span, bucket_rows=bucket_rows, fanout=fanout)) == as_dict(found)
    assert found.columns == [*log.columns, "offsets"] and oo.with_offset_vector(log.limit(0), n).count() == 0


def test_global_window_is_the_same(spark, rows):
    assert as_dict(oo.global_offset_vector(make_log(spark, rows), 5)) == brute_force(rows, 5)


def test_log_is_shuffled_once_and_totals_share_a_scan(spark, rows, tmp_path):
    make_log(spark, rows).withColumn("payload", F.lit("x")).write.parquet(str(tmp_path / "log"))
    out = oo.with_offset_vector(spark.read.parquet(str(tmp_path / "log")), 5, bucket_rows=64, fanout=4)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("payload") > 0
    assert plan.count("ReusedExchange") == 1
    assert plan.count("FileScan parquet [seq") == 2


def test_bad_arguments(spark, rows):
    with pytest.raises(ValueError):
        oo.with_offset_vector(make_log(spark, rows), 0)
    with pytest.raises(ValueError):
        oo.with_offset_vector(make_log(spark, rows), 5, ["00"])


@pytest.mark.parametrize("start", [["00000100", None, "00000200", "00000000", "000005ff"], ["00000001"] * 5, [None] * 5])
@pytest.mark.parametrize("wide", [False, True])
def test_begin_at(spark, rows, start, wide):
    if wide:
        start = start + ["00000001"] * 70
    expected = {s for s, p in rows if start[p] is None or format(s, "08x") > start[p]}
    log = make_log(spark, rows)
    assert {r["seq"] for r in oo.begin_at(log, start).collect()} == expected
    frame = spark.range(1).select(fo.vector_literal(start).alias("offsets"))
    assert {r["seq"] for r in oo.begin_at(log, frame).collect()} == expected


def test_begin_at_reaches_the_scan(spark, rows, tmp_path, capsys):
    make_log(spark, rows).write.parquet(str(tmp_path / "log"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # or the plan's text is cut short
    oo.begin_at(spark.read.parquet(str(tmp_path / "log")), ["00000100", "00000200"]).explain()
    pushed = capsys.readouterr().out.split("PushedFilters:")[1]
    assert "GreaterThan(Offset" in pushed and "EqualTo(PartitionId" in pushed


def test_last_vector(spark, rows):
    expected = brute_force(rows, 5)[max(rows)[0]]
    assert oo.last_vector(make_log(spark, rows), 6).first()["offsets"] == [*expected, None]


def test_text_forms(spark):
    row = spark.range(1).select(
        fo.format_offsets(fo.vector_literal(["1", "10", None, "2"])).alias("text"),
        fo.parse_offsets(F.lit("1,10,null,2")).alias("parsed"),
        fo.parse_offsets(F.lit("AB,NULL"), any_case=True).alias("any"),
        fo.invalid_offsets(F.lit("0123456789abcdefABCDEF,NULL,NULL,0123")).alias("good"),
        fo.invalid_offsets(F.lit("")).alias("empty"),
        fo.invalid_offsets(F.lit("0123456789abcdefABCDEFGE,NULL1,01")).alias("bad"),
        fo.to_hex(F.lit(bytearray(b"\x00\xab"))).alias("hex"),
        fo.no_offset(fo.vector_literal([None, None])).alias("none"),
        fo.no_offset(fo.vector_literal([None, "1"])).alias("some"),
    ).first()
    assert row["text"] == "1,10,null,2"
    assert row["parsed"] == ["1", "10", None, "2"]
    assert row["any"] == ["AB", None]
    assert row["good"] == [] and row["empty"] == []
    assert row["bad"] == ["0123456789abcdefABCDEFGE", "NULL1"]
    assert row["hex"] == "00ab" and row["none"] and not row["some"]


@pytest.mark.parametrize(
    "stored, oldest, stale",
    [
        (["05", "05"], ["05", "04"], False),
        (["05", "05"], ["05", "06"], True),
        (["05", None], ["04", "06"], False),
        (["05", "05"], [None, None], False),
    ],
)
def test_stale(spark, stored, oldest, stale):
    def frame(v):
        return spark.range(1).select(fo.vector_literal(v).alias("offsets"))

    assert oo.is_stale(frame(stored), frame(oldest)).first()["stale"] is stale
