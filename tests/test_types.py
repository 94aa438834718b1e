"""Golden values per source type and mode."""

from __future__ import annotations

import datetime as dt
import struct
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField

from tidemark.config import CdcConfig
from tidemark.functions import binary as fb
from tidemark.functions import defaults as fd
from tidemark.functions import geography as fg
from tidemark.functions import masks as fm
from tidemark.functions import temporal as ft
from tidemark.functions import types as fy
from tidemark.functions import vector as fv
from tidemark.sources.catalog import raw_type

CONFIG = CdcConfig(topic_prefix="p", db="db", table="t")


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def converted(spark, name, value, config=CONFIG, nullable=True):
    field = StructField("c", raw_type(name), nullable, {"type": name})
    frame = spark.createDataFrame([(value,)], "c " + raw_type(name).simpleString())
    return frame.select(fy.convert_column(field, config).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "name, value, expected",
    [
        ("BOOL", 1, 1),
        ("TINYINT", -128, -128),
        ("SMALLINT", -32768, -32768),
        ("MEDIUMINT", -8388608, -8388608),
        ("INT", -2147483648, -2147483648),
        ("BIGINT", -9223372036854775808, -9223372036854775808),
        ("DOUBLE", -1000.01, -1000.01),
        ("BIT(64)", bytearray(b"abcdefgh"), bytearray(b"abcdefgh")),
        ("DATE", dt.date(1000, 1, 1), -354285),
        ("TIME", "-838:59:59", -3020399000),
        ("TIME(6)", "-837:59:59.123456", -3016799123456),
        ("YEAR", 1901, 1901),
        ("DECIMAL(5,2)", Decimal("100.00"), Decimal("100.00")),
        (
            "DECIMAL(65,30)",
            "12345678901234567890123456789012345.123456789012345678901234567891",
            "12345678901234567890123456789012345.123456789012345678901234567891",
        ),
        ("JSON", '{ "a" :1}', '{ "a" :1}'),
        ("ENUM('a','b')", "val1", "val1"),
        ("VECTOR(3, I16)", [1, 10, 100], "[1,10,100]"),
        ("VECTOR(3, F32)", [1.1, 10.1, 100.1], "[1.1,10.1,100.1]"),
        ("VECTOR(3, F64)", [1.0, 2.0], "[1.0,2.0]"),
        ("BSON", bytearray(b"\x05\0\0\0\0"), bytearray(b"\x05\0\0\0\0")),
    ],
)
def test_default_modes(spark, name, value, expected):
    assert converted(spark, name, value) == expected


@pytest.mark.parametrize(
    "name, text, expected",
    [
        ("DATETIME", "1000-01-01 00:00:00", -30610224000000),
        ("DATETIME(6)", "1000-01-01 00:00:00.123456", -30610223999876544),
        ("TIMESTAMP", "1970-01-01 00:00:01", 1000),
        ("TIMESTAMP(6)", "1970-01-01 00:00:01.123456", 1123456),
    ],
)
def test_timestamps(spark, name, text, expected):
    field = StructField("c", raw_type(name), True, {"type": name})
    raw = F.lit(text).cast("timestamp")
    assert one(spark, fy.convert_column(field, CONFIG, raw)) == expected
    kept = one(spark, F.unix_micros(fy.convert_column(field, replace(CONFIG, time_mode="connect"), raw)))
    assert kept == (expected * 1000 if name in ("DATETIME", "TIMESTAMP") else expected // 1000 * 1000)


def test_other_modes(spark):
    assert converted(spark, "DATE", dt.date(2000, 1, 1), replace(CONFIG, time_mode="connect")) == dt.date(2000, 1, 1)
    assert converted(spark, "TIME", "01:00:00", replace(CONFIG, time_mode="adaptive_time_microseconds")) == 3600000000
    assert converted(spark, "TIME(6)", "-0:00:01.5", replace(CONFIG, time_mode="connect")) == 1500
    assert converted(spark, "DECIMAL(5,2)", Decimal("1.50"), replace(CONFIG, decimal_mode="double")) == 1.5
    assert converted(spark, "DECIMAL(5,2)", Decimal("1.50"), replace(CONFIG, decimal_mode="string")) == "1.50"


@pytest.mark.parametrize(
    "text, micros",
    [
        ("22:59:59", 82799000000),
        ("22:59", 82740000000),
        ("22:59:59.111111", 82799111111),
        ("-838:59:59", -3020399000000),
        ("-0:30:00", 1800000000),
        ("1:0:0.1234567", 3600123456),
        ("1:2.5", 3720000000),
        ("nonsense", None),
        (None, None),
    ],
)
def test_durations(spark, text, micros):
    assert one(spark, ft.parse_duration(F.lit(text).cast("string"), strict=False)) == micros


@pytest.mark.parametrize("name", ["TIME", "VECTOR(2, F32)"])
def test_unreadable_defaults_raise(spark, name):
    config = replace(CONFIG, vector_mode="array")
    with pytest.raises(Exception, match="unexpected format|unreadable default"):
        one(spark, fd.parse_default(F.lit("nonsense"), name, True, config))


def test_unsigned_types_keep_their_numbers(spark):
    raw = {n: raw_type(n).simpleString() for n in ("SMALLINT UNSIGNED", "INT UNSIGNED", "BIGINT UNSIGNED")}
    assert list(raw.values()) == ["int", "bigint", "decimal(20,0)"]


def test_bad_duration_raises(spark):
    with pytest.raises(Exception, match="unexpected format"):
        one(spark, ft.parse_duration(F.lit("nonsense")))


def test_milliseconds_are_cut_toward_zero(spark):
    assert one(spark, ft.convert_time(F.lit(-1999).cast("bigint"), "adaptive", 10)) == -1


@pytest.mark.parametrize(
    "mode, expected",
    [
        ("bytes", bytearray(b"test value")),
        ("base64", "dGVzdCB2YWx1ZQ=="),
        ("base64-url-safe", "dGVzdCB2YWx1ZQ=="),
        ("hex", "746573742076616c7565"),
    ],
)
def test_binary_modes(spark, mode, expected):
    assert converted(spark, "BLOB", bytearray(b"test value"), replace(CONFIG, binary_mode=mode)) == expected


def test_base64_has_no_line_ends(spark):
    import base64

    data = bytes(range(256)) * 2
    column = F.lit(bytearray(data))
    assert one(spark, fb.convert_binary(column, "base64")) == base64.b64encode(data).decode()
    assert one(spark, fb.convert_binary(column, "base64-url-safe")) == base64.urlsafe_b64encode(data).decode()


@pytest.mark.parametrize(
    "element, values, expected",
    [
        ("I8", [1, 10, 100], [1, 10, 100]),
        ("I16", [1, 10, 100], [1, 0, 10, 0, 100, 0]),
        ("I32", [2, 10, 100], [2, 0, 0, 0, 10, 0, 0, 0, 100, 0, 0, 0]),
        ("F32", [1.1, 10.1, 100.1], [-51, -52, -116, 63, -102, -103, 33, 65, 51, 51, -56, 66]),
        ("F64", [2.1, 10.1, 100.1], list(struct.pack("<3d", 2.1, 10.1, 100.1))),
    ],
)
def test_vector_bytes(spark, element, values, expected):
    frame = spark.createDataFrame([(values,), (None,), ([],), (values,)], f"v array<{fv.ELEMENT_SPARK[element]}>")
    got = [r[0] for r in frame.coalesce(1).select(fv.convert_vector("v", element, "binary")).collect()]
    want = bytearray(b % 256 for b in expected)
    assert got == [want, None, bytearray(), want]


def test_vector_types(spark):
    row = one(spark, fv.parse_vector_type(F.lit("VECTOR(3, I16)")))
    assert row.asDict() == {"length": 3, "element_type": "I16", "element_bytes": 2, "total_bytes": 6}
    with pytest.raises(Exception, match="invalid VECTOR type"):
        one(spark, fv.parse_vector_type(F.lit("VECTOR(3, I12)")))
    assert one(spark, fv.parse_vector_type(F.lit("VECTOR(x)"), strict=False)) is None


def wkb(shape, rings):
    out = struct.pack(">BI", 0, shape)
    if shape == 1:
        return bytearray(out + struct.pack(">2d", *rings[0][0]))
    if shape == 3:
        out += struct.pack(">I", len(rings))
    for ring in rings:
        out += struct.pack(">I", len(ring)) + b"".join(struct.pack(">2d", *p) for p in ring)
    return bytearray(out)


def test_long_path(spark):
    ring = [(i, -i / 4) for i in range(50000)]
    text = "POLYGON((" + ",".join(f"{x} {y}" for x, y in ring) + "))"
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(fg.wkt_to_wkb("t").alias("w")).first()["w"] == wkb(3, [ring])


def test_geography(spark):
    square = [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]
    cases = [
        ("POLYGON((1 1,2 1,2 2, 1 2, 1 1))", wkb(3, [square])),
        ("POINT(1.50000003 1.50000000)", wkb(1, [[(1.50000003, 1.5)]])),
        ("linestring ( -1e2 0.5 , 3 4)", wkb(2, [[(-100, 0.5), (3, 4)]])),
        ("POLYGON((1 1,2 1,2 2,1 2,1 1),(0 0,1 0,1 1,0 0))", wkb(3, [square, [(0, 0), (1, 0), (1, 1), (0, 0)]])),
        ("CIRCLE(1 1)", None),
        ("POINT(1)", None),
        (None, None),
    ]
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string").coalesce(1)
    got = frame.select("i", fg.convert_geography("t").alias("g")).orderBy("i").collect()
    assert [r["g"] and r["g"]["wkb"] for r in got] == [w for _, w in cases]
    assert all(r["g"] is None or r["g"]["srid"] is None for r in got)
    required = frame.select("i", fg.convert_geography("t", nullable=False).alias("g")).orderBy("i").collect()
    assert required[-1]["g"]["wkb"].hex() == "010700000000000000"
    assert one(spark, fg.convert_geography(F.lit("CIRCLE(1 1)"), "string")) == "CIRCLE(1 1)"


@pytest.mark.parametrize(
    "text, name, expected",
    [
        ("124", "TINYINT", 124),
        ("8388607", "MEDIUMINT", 8388607),
        ("9223372036854775807", "BIGINT", 9223372036854775807),
        ("100.1", "DOUBLE", 100.1),
        ("1989", "YEAR", 1989),
        ("2000-10-10", "DATE", 11240),
        ("22:59:59", "TIME", 82799000),
        ("22:59:59.111111", "TIME(6)", 82799111111),
        ("2023-12-31 23:59:59", "DATETIME", 1704067199000),
        ("2023-12-31 22:59:59.111111", "DATETIME(6)", 1704063599111111),
        ("2022-01-19 03:14:07", "TIMESTAMP", 1642562047000),
        ("abc", "VARBINARY(3)", bytearray(b"abc")),
        ("\x05\0\0\0\0", "BSON", bytearray(b"\x05\0\0\0\0")),
        ("val1", "ENUM('val1')", "val1"),
        ("[2, 10, 100]", "VECTOR(3, I8)", "[2, 10, 100]"),
        ("POINT(1 1)", "GEOGRAPHYPOINT", None),
        ("CURRENT_TIMESTAMP", "DATETIME", None),
        (None, "INT", None),
    ],
)
def test_defaults(spark, text, name, expected):
    assert one(spark, fd.parse_default(F.lit(text).cast("string"), name, True, CONFIG)) == expected


def test_defaults_of_required_columns_and_other_modes(spark):
    def default(text, name, nullable=True, **modes):
        return one(spark, fd.parse_default(F.lit(text), name, nullable, replace(CONFIG, **modes)))

    assert default("CURRENT_TIMESTAMP", "DATETIME", False) == 0
    assert default("never", "DATE", False) == 0
    assert default("[2, 10, 100]", "VECTOR(3, I16)", vector_mode="array") == [2, 10, 100]
    assert default("[2, 10, 100]", "VECTOR(3, I16)", vector_mode="binary") == bytearray([2, 0, 10, 0, 100, 0])
    assert default("POINT(1 1)", "GEOGRAPHYPOINT", geography_mode="string") == "POINT(1 1)"


def test_null_fallbacks(spark):
    none = F.lit(None).cast("int")
    assert one(spark, fy.null_fallback(none, "YEAR", False)) == 0
    assert one(spark, fy.null_fallback(none, "YEAR", True)) is None
    assert one(spark, fy.null_fallback(F.lit(None).cast("bigint"), "TIME", False)) == 0
    assert one(spark, fy.null_fallback(F.lit(None).cast("binary"), "BLOB", False)) == bytearray()
    assert one(spark, fy.null_fallback(F.lit(None).cast("array<float>"), "VECTOR(2, F32)", False, replace(CONFIG, vector_mode="array"))) == []


def test_masks(spark):
    assert one(spark, fm.mask_chars(F.lit("abc"), 10)) == "*" * 10
    assert one(spark, fm.mask_chars(F.lit(None).cast("string"), 10)) is None
    assert one(spark, fm.truncate_chars(F.lit("ein äußerst langer"), 10)) == "ein äußers"
    assert one(spark, fm.mask_hash(F.lit("x"), "SHA-256", "s")) != "x"
    with pytest.raises(ValueError):
        fm.mask_hash(F.lit("x"), "CRC", "s")
