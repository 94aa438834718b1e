"""Queries over type conversions, masks and defaults."""

from __future__ import annotations

import json
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType, TimestampNTZType

from ..config import TIME_MODES, CdcConfig
from ..functions import binary as fb
from ..functions import defaults as fd
from ..functions import geography as fg
from ..functions import masks as fm
from ..functions import temporal as ft
from ..functions import types as fy
from ..functions import vector as fv
from ..functions.offsets import to_hex
from ..operators import columns as oc
from ..operators import envelope as oe
from ..operators import sinks as os_
from ..sources import catalog
from . import fixtures as fx
from .fixtures import CUSTOMER_CONFIG
from .pipeline import cdc_events
from .registry import query
from .snapshot_queries import CUSTOMER_TABLE


@query(
    "mask_hash",
    """SELECT c_custkey, sha256('pepper' || c_name) AS h256, md5('pepper' || c_name) AS h5, sha1('pepper' || c_name) AS h1 FROM customer""",
)
def mask_hash_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "customer").select(
        "c_custkey",
        fm.mask_hash("c_name", "SHA-256", "pepper").alias("h256"),
        fm.mask_hash("c_name", "MD5", "pepper").alias("h5"),
        fm.mask_hash("c_name", "SHA-1", "pepper").alias("h1"),
    )


@query("mask_chars", "SELECT c_custkey, repeat('*', 10) AS c_name, repeat('*', 3) AS c_mktsegment FROM customer")
def mask_chars_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "customer").select(
        "c_custkey", fm.mask_chars("c_name", 10).alias("c_name"), fm.mask_chars("c_mktsegment", 3).alias("c_mktsegment")
    )


@query("truncate_chars", "SELECT doc_id, substr(text, 1, 10) AS head, substr(lang, 1, 1) AS lang1 FROM documents")
def truncate_chars_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "documents").select(
        "doc_id", fm.truncate_chars("text", 10).alias("head"), fm.truncate_chars("lang", 1).alias("lang1")
    )


@query(
    "column_masks",
    """SELECT c_custkey, sha256('s' || c_name) AS c_name, c_nationkey, c_acctbal, substr(c_mktsegment, 1, 4) AS c_mktsegment FROM customer""",
)
def column_masks_query(spark, sf_dir):
    config = replace(
        CUSTOMER_CONFIG, mask_hash={("SHA-256", "s"): r"shop\.customer\.c_name"}, truncate={4: r".*\.c_mktsegment"}
    )
    customer = fx.load(spark, sf_dir, "customer")
    return customer.withColumns(oc.masked(config, customer.schema))


@query(
    "describe_types",
    """SELECT 'c_name' AS column_name, 'VARCHAR' AS source_type, '25' AS source_length, NULL::VARCHAR AS source_scale, count(c_name) AS n_values FROM customer
      UNION ALL SELECT 'c_nationkey', 'INT', '10', '0', count(c_nationkey) FROM customer
      UNION ALL SELECT 'c_mktsegment', 'VARCHAR', '10', NULL, count(c_mktsegment) FROM customer""",
)
def describe_types_query(spark, sf_dir):
    config = replace(CUSTOMER_CONFIG, propagate_types=r".+\.VARCHAR", propagate_columns=r".*\.c_nationkey")
    return oc.describe_types(oc.propagate_type(fx.load(spark, sf_dir, "customer"), CUSTOMER_TABLE, config))


@query(
    "numeric_types",
    """SELECT l_orderkey, l_linenumber, l_linenumber::SMALLINT AS small, l_partkey::INTEGER AS medium,
      l_tax::FLOAT::DOUBLE AS single FROM lineitem""",
)
def numeric_types_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        fy.to_smallint("l_linenumber").alias("small"),
        fy.to_int("l_partkey").alias("medium"),
        fy.to_float("l_tax").cast("double").alias("single"),
    )


@query(
    "decimal_modes",
    """SELECT l_orderkey, l_partkey, l_extendedprice::DECIMAL(15,2)::VARCHAR AS precise,
      l_extendedprice::DECIMAL(15,2)::DOUBLE AS as_double, l_extendedprice::DECIMAL(15,2)::VARCHAR AS as_string,
      l_extendedprice::DECIMAL(15,2)::VARCHAR AS too_wide FROM lineitem""",
)
def decimal_modes_query(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(15,2)")
    return fx.load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        fy.convert_decimal(price, "precise", 15, 2).cast("string").alias("precise"),
        fy.convert_decimal(price, "double").alias("as_double"),
        fy.convert_decimal(price, "string").alias("as_string"),
        fy.convert_decimal(price, "precise", 65, 30).alias("too_wide"),
    )


@query(
    "temporal_modes",
    """WITH t AS (SELECT o_orderkey, o_orderdate + to_microseconds(o_orderkey) AS m FROM orders)
      SELECT o_orderkey, date_diff('day', DATE '1970-01-01', m::DATE)::INTEGER AS days, m::DATE::VARCHAR AS day_kept,
        epoch_us(m) // 1000 AS millis, epoch_us(m) AS micros, epoch_us(m) // 1000 * 1000 AS connect_micros FROM t""",
)
def temporal_modes_query(spark, sf_dir):
    orders = fx.load(spark, sf_dir, "orders")
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")
    return orders.select("o_orderkey", F.timestamp_micros(micros).alias("m")).select(
        "o_orderkey",
        ft.convert_date("m").alias("days"),
        ft.convert_date("m", "connect").cast("string").alias("day_kept"),
        ft.convert_timestamp("m", "adaptive", 19).alias("millis"),
        ft.convert_timestamp("m", "adaptive_time_microseconds", 26).alias("micros"),
        F.unix_micros(ft.convert_timestamp("m", "connect", 26)).alias("connect_micros"),
    )


_DURATION_TEXT = """CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '' END || ((l_quantity - 1) * 13)::BIGINT || ':' ||
  lpad((l_partkey % 60)::VARCHAR, 2, '0') || CASE WHEN l_linenumber = 7 THEN '' ELSE ':' || lpad((l_suppkey % 60)::VARCHAR, 2, '0') || '.' || (l_orderkey % 1000000) END"""


@query(
    "time_durations",
    f"""WITH t AS (SELECT l_orderkey, l_partkey, l_linenumber, {_DURATION_TEXT} AS txt,
        ((l_quantity - 1) * 13)::BIGINT AS h, l_partkey % 60 AS mi,
        CASE WHEN l_linenumber = 7 THEN 0 ELSE l_suppkey % 60 END AS s,
        CASE WHEN l_linenumber = 7 THEN 0 ELSE (rpad((l_orderkey % 1000000)::VARCHAR, 6, '0'))::BIGINT END AS f FROM lineitem),
      u AS (SELECT *, (h * 3600 + mi * 60 + s) * 1000000 + f AS size,
        CASE WHEN l_linenumber % 2 = 0 AND h > 0 THEN -1 ELSE 1 END AS sign FROM t)
      SELECT l_orderkey, l_partkey, txt, (sign * size)::BIGINT AS micros, (sign * (size // 1000))::BIGINT AS adaptive_time,
        (sign * size)::BIGINT AS adaptive_time6, (sign * (size // 1000))::BIGINT AS connect_time FROM u""",
)
def time_durations_query(spark, sf_dir):
    def two(c: str) -> Column:
        return F.lpad((F.col(c) % 60).cast("string"), 2, "0")

    seconds = F.concat(F.lit(":"), two("l_suppkey"), F.lit("."), (F.col("l_orderkey") % 1000000).cast("string"))
    text = F.concat(
        F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise(""),
        ((F.col("l_quantity") - 1) * 13).cast("bigint").cast("string"),
        F.lit(":"),
        two("l_partkey"),
        F.when(F.col("l_linenumber") == 7, "").otherwise(seconds),
    )
    rows = fx.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", text.alias("txt"))
    rows = rows.withColumn("micros", ft.parse_duration("txt"))
    return rows.select(
        "*",
        ft.convert_time("micros", "adaptive", 10).alias("adaptive_time"),
        ft.convert_time("micros", "adaptive", 17).alias("adaptive_time6"),
        ft.convert_time("micros", "connect", 17).alias("connect_time"),
    )


@query(
    "year_values",
    "SELECT o_orderkey, year(o_orderdate)::INTEGER AS from_date, year(o_orderdate)::INTEGER AS from_text, (o_orderkey % 200 + 1901)::INTEGER AS from_number FROM orders",
)
def year_values_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "orders").select(
        "o_orderkey",
        ft.convert_year(F.col("o_orderdate").cast("date"), "date").alias("from_date"),
        ft.convert_year(F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy")).alias("from_text"),
        ft.convert_year(F.col("o_orderkey") % 200 + 1901).alias("from_number"),
    )


@query(
    "binary_modes",
    """SELECT doc_id, md5(lower(hex(encode(text)))) AS bytes_hex, to_base64(encode(text)) AS b64,
      replace(replace(to_base64(encode(text)), '+', '-'), '/', '_') AS b64_url, lower(hex(encode(text))) AS hex FROM documents""",
)
def binary_modes_query(spark, sf_dir):
    data = F.encode("text", "UTF-8")
    return fx.load(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5(to_hex(fb.convert_binary(data))).alias("bytes_hex"),
        fb.convert_binary(data, "base64").alias("b64"),
        fb.convert_binary(data, "base64-url-safe").alias("b64_url"),
        fb.convert_binary(data, "hex").alias("hex"),
    )


@query(
    "bit_values",
    """SELECT c_custkey, lower(hex(encode(c_name))) AS same, array_to_string(list_reverse(regexp_extract_all(lower(hex(encode(c_name))), '..')), '') AS turned FROM customer""",
)
def bit_values_query(spark, sf_dir):
    data = F.encode("c_name", "UTF-8")
    return fx.load(spark, sf_dir, "customer").select(
        "c_custkey", to_hex(fb.convert_bit(data)).alias("same"), to_hex(fb.convert_bit(data, True)).alias("turned")
    )


@query(
    "kept_text",
    "SELECT event_id, props AS json, event_type AS enum FROM events",
)
def kept_text_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "events").select(
        "event_id", fy.keep_text("props").alias("json"), fy.keep_text("event_type").alias("enum")
    )


@query(
    "vector_array",
    """SELECT vec_id, unnest(range(64))::INTEGER AS pos, unnest(embedding)::DOUBLE AS f32,
      unnest(list_transform(embedding, lambda x: round(x::DOUBLE * 100)::INTEGER)) AS i32 FROM embeddings""",
)
def vector_array_query(spark, sf_dir):
    f32 = fv.convert_vector("embedding", "F32", "array")
    i32 = fv.convert_vector(_scaled(100), "I32", "array")
    rows = fx.load(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(F.arrays_zip(f32.alias("f"), i32.alias("i"))))
    return rows.select("vec_id", "pos", F.col("col.f").cast("double").alias("f32"), F.col("col.i").alias("i32"))


def _scaled(factor: int, divide: int = 1) -> Column:
    """The embeddings as whole numbers, or as exact binary fractions."""
    return F.transform("embedding", lambda x: F.round(x.cast("double") * factor) / divide)


def _le_sql(kind: str, factor: int | None) -> str:
    value = "x" if factor is None else f"round(x::DOUBLE * {factor})"
    return (
        f"array_to_string(list_transform(embedding, lambda x: array_to_string(list_reverse("
        f"regexp_extract_all(lower(hex(({value})::{kind}::BIT::BLOB)), '..')), '')), '')"
    )


@query(
    "vector_binary",
    f"""SELECT vec_id, {_le_sql('FLOAT', None)} AS f32, {_le_sql('DOUBLE', None)} AS f64, {_le_sql('TINYINT', 100)} AS i8,
      {_le_sql('SMALLINT', 1000)} AS i16, {_le_sql('INTEGER', 100000)} AS i32, {_le_sql('BIGINT', 100000)} AS i64 FROM embeddings""",
)
def vector_binary_query(spark, sf_dir):
    def packed(c: Column | str, element: str) -> Column:
        return fv.convert_vector(c, element, "binary", "hex").alias(element.lower())

    return fx.load(spark, sf_dir, "embeddings").select(
        "vec_id",
        packed("embedding", "F32"),
        packed("embedding", "F64"),
        packed(_scaled(100), "I8"),
        packed(_scaled(1000), "I16"),
        packed(_scaled(100000), "I32"),
        packed(_scaled(100000), "I64"),
    )


@query("vector_binary_length", "SELECT vec_id, len(embedding) * 4 AS n_bytes, len(embedding) * 8 AS n_bytes64 FROM embeddings")
def vector_binary_length_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.length(fv.convert_vector("embedding", "F32", "binary")).cast("bigint").alias("n_bytes"),
        F.length(fv.convert_vector("embedding", "F64", "binary")).cast("bigint").alias("n_bytes64"),
    )


@query(
    "vector_string",
    """SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 100)::INTEGER), ',') || ']' AS ints,
      '[' || array_to_string(list_transform(embedding, lambda x: round(x::DOUBLE * 64)::INTEGER / 64), ',') || ']' AS fractions FROM embeddings""",
)
def vector_string_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "embeddings").select(
        "vec_id",
        fv.convert_vector(_scaled(100), "I16", "string").alias("ints"),
        fv.convert_vector(F.transform(_scaled(64, 64), lambda x: x + F.lit(0.0)), "F64", "string").alias("fractions"),
    )


@query(
    "vector_json",
    """SELECT vec_id, unnest(list_transform(embedding, lambda x: round(x::DOUBLE * 64)::INTEGER / 64)) AS value FROM embeddings""",
)
def vector_json_query(spark, sf_dir):
    text = fv.convert_vector(_scaled(64, 64), "F32", "string")
    rows = fx.load(spark, sf_dir, "embeddings").select("vec_id", text.alias("txt"))
    parsed = fv.parse_vector_json("txt", "F32")
    return rows.select("vec_id", F.explode(parsed).alias("value")).withColumn("value", F.col("value").cast("double"))


@query(
    "type_names",
    """WITH t AS (SELECT l_orderkey, l_partkey, CASE WHEN l_linenumber % 3 = 0 THEN 'decimal(' || l_quantity::INTEGER || ',2)'
        WHEN l_linenumber % 3 = 1 THEN 'VECTOR(' || l_quantity::INTEGER || ', ' || CASE l_returnflag WHEN 'N' THEN 'F32' WHEN 'A' THEN 'I8' ELSE 'I64' END || ')'
        ELSE 'tinyint unsigned' END AS name, l_linenumber, l_quantity::INTEGER AS q,
        CASE l_returnflag WHEN 'N' THEN 'F32' WHEN 'A' THEN 'I8' ELSE 'I64' END AS e FROM lineitem)
      SELECT l_orderkey, l_partkey, name, CASE l_linenumber % 3 WHEN 0 THEN 'DECIMAL' WHEN 1 THEN 'VECTOR' ELSE 'TINYINT UNSIGNED' END AS base,
        CASE WHEN l_linenumber % 3 = 1 THEN q END AS length, CASE WHEN l_linenumber % 3 = 1 THEN e END AS element,
        CASE WHEN l_linenumber % 3 = 1 THEN q * CASE e WHEN 'F32' THEN 4 WHEN 'I8' THEN 1 ELSE 8 END END AS total_bytes FROM t""",
)
def type_names_query(spark, sf_dir):
    quantity = F.col("l_quantity").cast("int").cast("string")
    flag = F.col("l_returnflag")
    element = F.when(flag == "N", "F32").when(flag == "A", "I8").otherwise("I64")
    kind = F.col("l_linenumber") % 3
    name = (
        F.when(kind == 0, F.concat(F.lit("decimal("), quantity, F.lit(",2)")))
        .when(kind == 1, F.concat(F.lit("VECTOR("), quantity, F.lit(", "), element, F.lit(")")))
        .otherwise("tinyint unsigned")
    )
    rows = fx.load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", name.alias("name"))
    rows = rows.withColumn("v", fv.parse_vector_type("name", strict=False))
    return rows.select(
        "l_orderkey",
        "l_partkey",
        "name",
        fy.base_type("name").alias("base"),
        "v.length",
        F.col("v.element_type").alias("element"),
        "v.total_bytes",
    )


def _wkt() -> Column:
    """A point, a line or a ring per customer; text where the two engines print numbers alike."""
    nation, balance = F.col("c_nationkey").cast("string"), F.col("c_acctbal").cast("string")
    kind = F.col("c_custkey") % 3
    return (
        F.when(kind == 0, F.concat(F.lit("POINT("), nation, F.lit(" "), balance, F.lit(")")))
        .when(kind == 1, F.concat(F.lit("LINESTRING("), nation, F.lit(" 0, 0.5 "), balance, F.lit(")")))
        .otherwise(
            F.concat(F.lit("POLYGON((0 0,"), nation, F.lit(" 0,"), nation, F.lit(" "), balance, F.lit(", 0 0))"))
        )
    )


def _be(value: str) -> str:
    return f"lower(hex(({value})::DOUBLE::BIT::BLOB))"


_N, _B = _be("c_nationkey"), _be("c_acctbal")
_Z, _H = "0" * 16, "3fe0000000000000"
WKB_SQL = f"""CASE c_custkey % 3 WHEN 0 THEN '0000000001' || {_N} || {_B}
  WHEN 1 THEN '000000000200000002' || {_N} || '{_Z}' || '{_H}' || {_B}
  ELSE '00000000030000000100000004{_Z}{_Z}' || {_N} || '{_Z}' || {_N} || {_B} || '{_Z}{_Z}' END"""
WKT_SQL = """CASE c_custkey % 3 WHEN 0 THEN 'POINT(' || c_nationkey || ' ' || c_acctbal || ')'
  WHEN 1 THEN 'LINESTRING(' || c_nationkey || ' 0, 0.5 ' || c_acctbal || ')'
  ELSE 'POLYGON((0 0,' || c_nationkey || ' 0,' || c_nationkey || ' ' || c_acctbal || ', 0 0))' END"""


@query("geography_wkb", f"SELECT c_custkey, true AS srid_is_null, {WKB_SQL} AS wkb FROM customer")
def geography_wkb_query(spark, sf_dir):
    rows = fx.load(spark, sf_dir, "customer").select("c_custkey", fg.convert_geography(_wkt()).alias("g"))
    return rows.select("c_custkey", F.col("g.srid").isNull().alias("srid_is_null"), to_hex("g.wkb").alias("wkb"))


@query("geography_string", f"SELECT c_custkey, {WKT_SQL} AS txt FROM customer")
def geography_string_query(spark, sf_dir):
    return fx.load(spark, sf_dir, "customer").select("c_custkey", fg.convert_geography(_wkt(), "string").alias("txt"))


@query("geography_points", f"SELECT c_custkey, '0000000001' || {_N} || {_B} AS wkb FROM customer")
def geography_points_query(spark, sf_dir):
    text = F.concat(
        F.lit("POINT ("), F.col("c_nationkey").cast("string"), F.lit(" "), F.col("c_acctbal").cast("string"), F.lit(")")
    )
    rows = fx.load(spark, sf_dir, "customer").select("c_custkey", fg.convert_geography(text, points_only=True).alias("g"))
    return rows.select("c_custkey", to_hex("g.wkb").alias("wkb"))


@query(
    "null_fallbacks",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE 0 END AS year_value,
      CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE 0 END AS time_value,
      CASE WHEN c_custkey % 2 = 0 THEN lower(hex(encode(c_name))) ELSE '' END AS blob_value,
      CASE WHEN c_custkey % 2 = 0 THEN '[1]' ELSE '[]' END AS vector_value,
      CASE WHEN c_custkey % 2 = 0 THEN '000000000100000000000000000000000000000000' ELSE '010700000000000000' END AS wkb,
      CASE WHEN c_custkey % 2 = 0 THEN c_name END AS nullable_value FROM customer""",
)
def null_fallbacks_query(spark, sf_dir):
    def half(c: Column) -> Column:
        return F.when(F.col("c_custkey") % 2 == 0, c)

    return fx.load(spark, sf_dir, "customer").select(
        "c_custkey",
        fy.null_fallback(half(F.col("c_nationkey")), "YEAR", False).alias("year_value"),
        fy.null_fallback(half(F.col("c_custkey")), "TIME", False).alias("time_value"),
        to_hex(fy.null_fallback(half(F.encode("c_name", "UTF-8")), "BLOB", False)).alias("blob_value"),
        fy.null_fallback(half(F.lit("[1]")), "VECTOR(1, I8)", False).alias("vector_value"),
        to_hex(fg.convert_geography(half(F.lit("POINT(0 0)")), nullable=False)["wkb"]).alias("wkb"),
        fy.null_fallback(half(F.col("c_name")), "VARCHAR(25)", True).alias("nullable_value"),
    )


@query(
    "defaults",
    """WITH t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'CURRENT_TIMESTAMP' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS d,
        o_orderkey % 4 = 0 AS bad, o_orderdate AS m, (o_custkey % 24) AS h FROM orders)
      SELECT o_orderkey, d,
        CASE WHEN NOT bad THEN date_diff('day', DATE '1970-01-01', m::DATE)::INTEGER END AS date_default,
        CASE WHEN bad THEN 0 ELSE date_diff('day', DATE '1970-01-01', m::DATE)::INTEGER END AS date_required,
        CASE WHEN NOT bad THEN epoch_ms(m) END AS datetime_default,
        CASE WHEN bad THEN 0 ELSE epoch_us(m) END AS datetime6_required,
        h * 3600000 + 1800000 AS time_default,
        (o_orderkey % 100)::SMALLINT AS tiny_default, (o_orderkey % 100) / 4 AS double_default, ((o_orderkey % 100) / 4)::FLOAT::DOUBLE AS float_default,
        lower(hex(encode(d))) AS bit_default, d AS text_default,
        '[' || h || ',1]' AS vector_default, true AS geometry_is_null FROM t""",
)
def defaults_query(spark, sf_dir):
    bad = F.col("o_orderkey") % 4 == 0
    moment = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    hour = (F.col("o_custkey") % 24).cast("string")
    number = F.col("o_orderkey") % 100
    rows = fx.load(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(bad, "CURRENT_TIMESTAMP").otherwise(moment).alias("d"), hour.alias("h"), number.alias("n")
    )

    def default(text: Column | str, name: str, nullable: bool = True, **modes) -> Column:
        return fd.parse_default(text, name, nullable, replace(CUSTOMER_CONFIG, **modes))

    whole, quarter = F.col("n").cast("string"), (F.col("n") / 4).cast("string")
    vector = F.concat(F.lit("["), F.col("h"), F.lit(", 1]"))
    return rows.select(
        "o_orderkey",
        "d",
        default("d", "DATE").alias("date_default"),
        default("d", "DATE", False).alias("date_required"),
        default("d", "DATETIME").alias("datetime_default"),
        default("d", "DATETIME(6)", False).alias("datetime6_required"),
        default(F.concat("h", F.lit(":30:00")), "TIME").alias("time_default"),
        default(whole, "TINYINT").alias("tiny_default"),
        default(quarter, "DOUBLE").alias("double_default"),
        default(quarter, "FLOAT").cast("double").alias("float_default"),
        to_hex(default("d", "BIT(64)")).alias("bit_default"),
        default("d", "VARCHAR(30)").alias("text_default"),
        F.to_json(default(vector, "VECTOR(2, I16)", vector_mode="array")).alias("vector_default"),
        default(F.lit("POINT(1 1)"), "GEOGRAPHYPOINT").isNull().alias("geometry_is_null"),
    )


def _maybe_bad() -> Column:
    return F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit("CIRCLE("), "c_name", F.lit(")"))).otherwise(_wkt())


@query(
    "failure_mode",
    f"""SELECT c_custkey, c_custkey % 10 = 0 AS rejected, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE {WKB_SQL} END AS wkb FROM customer
      UNION ALL SELECT c_custkey, NULL, {WKB_SQL} FROM customer WHERE c_custkey % 10 <> 0""",
)
def failure_mode_query(spark, sf_dir):
    rows = fx.load(spark, sf_dir, "customer").withColumn("raw", _maybe_bad())
    attempt = {"wkb": (F.col("raw"), to_hex(fg.wkt_to_wkb("raw")))}
    good, bad = oe.failure_mode(rows, attempt, "warn")
    ignored, _ = oe.failure_mode(rows, attempt, "ignore")
    warned = good.select("c_custkey", F.lit(False).alias("rejected"), "wkb").unionByName(
        bad.select("c_custkey", F.lit(True).alias("rejected"), F.lit(None).cast("string").alias("wkb"))
    )
    return warned.unionByName(ignored.select("c_custkey", F.lit(None).cast("boolean").alias("rejected"), "wkb"))


@query("failure_mode_fail", f"SELECT c_custkey, {WKB_SQL} AS wkb FROM customer")
def failure_mode_fail_query(spark, sf_dir):
    rows = fx.load(spark, sf_dir, "customer").withColumn("raw", _wkt())
    good, _ = oe.failure_mode(rows, {"wkb": (F.col("raw"), to_hex(fg.wkt_to_wkb("raw")))}, "fail")
    return good.select("c_custkey", "wkb")


# A table with every type whose message form is an encoded number.
ORDERS_TABLE = StructType(
    [
        StructField("o_orderkey", LongType(), False, {"type": "BIGINT", "primary_key": True}),
        StructField("price", DecimalType(15, 2), True, {"type": "DECIMAL(15,2)"}),
        StructField("wide", DecimalType(30, 4), True, {"type": "DECIMAL(30,4)"}),
        StructField("day", DateType(), True, {"type": "DATE"}),
        StructField("clock", StringType(), True, {"type": "TIME(6)", "length": 17}),
        StructField("moment", TimestampNTZType(), True, {"type": "DATETIME(6)", "length": 26}),
        StructField("second", TimestampNTZType(), True, {"type": "DATETIME", "length": 19}),
    ]
)
ORDERS_CONFIG = CdcConfig(topic_prefix="app", db="shop", table="orders", partitions=fx.PARTITIONS, semantic_prefix="app.time")


def _orders_log(spark, sf_dir) -> DataFrame:
    orders = fx.load(spark, sf_dir, "orders")
    price = F.col("o_totalprice").cast("decimal(15,2)") - 150000
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) + (F.col("o_custkey") % 86400) * 1000000 + F.col("o_orderkey") % 1000000
    moment = F.timestamp_micros(micros).cast("timestamp_ntz")
    key = F.col("o_orderkey")
    return orders.select(
        *fx._log_columns(key, (key % fx.PARTITIONS), F.lit("Insert"), key, "orders"),
        "o_orderkey",
        price.cast("decimal(15,2)").alias("price"),
        (price * 1000).cast("decimal(30,4)").alias("wide"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.concat((F.col("o_custkey") % 24).cast("string"), F.lit(":15:30.25")).alias("clock"),
        moment.alias("moment"),
        moment.alias("second"),
    )


def _orders_schema(mode: str) -> str:
    connect = mode == "connect"
    logical = "org.apache.kafka.connect.data."
    decimal = [("price", 15, 2), ("wide", 30, 4)]
    rows = [{"type": "int64", "optional": False, "field": "o_orderkey"}]
    for name, precision, scale in decimal:
        facts = {"scale": str(scale), "connect.decimal.precision": str(precision)}
        rows.append({"type": "bytes", "optional": True, "name": f"{logical}Decimal", "version": 1, "parameters": facts, "field": name})
    if connect:
        rows.append({"type": "int32", "optional": True, "name": f"{logical}Date", "version": 1, "field": "day"})
        rows.append({"type": "int64", "optional": True, "field": "clock"})
        rows += [{"type": "int64", "optional": True, "name": f"{logical}Timestamp", "version": 1, "field": f} for f in ("moment", "second")]
    else:
        names = {"day": "Date", "clock": "MicroTime", "moment": "MicroTimestamp", "second": "Timestamp"}
        for field, name in names.items():
            kind = "int32" if field == "day" else "int64"
            rows.append({"type": kind, "optional": True, "field": field, "name": f"app.time.{name}", "version": 1})
    return json.dumps({"type": "struct", "fields": rows, "optional": True, "field": "after"}, separators=(",", ":"))


def _bytes_sql(number: str) -> str:
    size = f"list_filter(range(1, 9), lambda k: {number}::HUGEINT >= -(1::HUGEINT << (8 * k - 1)) AND {number}::HUGEINT < (1::HUGEINT << (8 * k - 1)))[1]"
    return f"to_base64(unhex(right(lpad(hex({number}), 16, '0'), (2 * {size})::INT)))"


def _orders_sql(mode: str) -> str:
    connect = mode == "connect"
    return f"""SELECT o_orderkey, '{mode}' AS mode, '{_orders_schema(mode)}' AS after_schema,
      '{{"o_orderkey":' || o_orderkey || ',"price":"' || price || '","wide":"' || wide || '","day":' || day
      || ',"clock":' || {"clock // 1000" if connect else "clock"} || ',"moment":' || {"micros // 1000" if connect else "micros"}
      || ',"second":' || micros // 1000 || '}}' AS after
      FROM encoded"""


@query(
    "messages_types",
    f"""WITH raw AS (
      SELECT o_orderkey, (o_totalprice::DECIMAL(15,2) * 100)::BIGINT - 15000000 AS n, (o_orderdate::DATE - DATE '1970-01-01')::BIGINT AS day,
        (o_custkey % 24) * 3600000000 + 930250000 AS clock,
        epoch_us(o_orderdate::TIMESTAMP) + (o_custkey % 86400) * 1000000 + o_orderkey % 1000000 AS micros FROM orders),
      wider AS (SELECT *, n * 100000 AS w FROM raw),
      encoded AS (SELECT o_orderkey, {_bytes_sql("n")} AS price, {_bytes_sql("w")} AS wide, day, clock, micros FROM wider)
      {" UNION ALL ".join(_orders_sql(m) for m in TIME_MODES)}""",
)
def messages_types_query(spark, sf_dir):
    """Decimals, dates, times and timestamps in messages: the payload and the schema it must fit, in each mode."""
    log = _orders_log(spark, sf_dir)
    frames = []
    for mode in TIME_MODES:
        config = replace(ORDERS_CONFIG, time_mode=mode)
        events = cdc_events(log, ORDERS_TABLE, config, ts_ms=F.lit(1).cast("bigint"))
        messages = os_.to_messages(events, "app.shop.orders", ORDERS_TABLE)
        frames.append(
            messages.select(
                F.get_json_object("key", "$.payload.o_orderkey").cast("bigint").alias("o_orderkey"),
                F.lit(mode).alias("mode"),
                F.get_json_object("value", "$.schema.fields[1]").alias("after_schema"),
                F.get_json_object("value", "$.payload.after").alias("after"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


# A catalog made of the part table: one column for each brand and size class, with a type by its number.
CATALOG_TYPES = ["BIGINT", "DECIMAL(15,2)", "DATE", "VARCHAR(20)", "DATETIME(6)", "BIT(64)", "VECTOR(4, F32)"]
CATALOG_SPARK = ["bigint", "decimal(15,2)", "date", "string", "timestamp", "binary", "array<float>"]


@query(
    "table_schema",
    f"""WITH cols AS (SELECT r_regionkey * 100 + n_nationkey AS position, n_name AS name,
        n_nationkey = 3 AS pk, n_nationkey % {len(CATALOG_TYPES)} AS k FROM nation JOIN region ON n_regionkey = r_regionkey)
      SELECT (row_number() OVER (ORDER BY position))::INTEGER AS place, name AS column_name,
        {CATALOG_SPARK!r}[k + 1] AS spark_type, {CATALOG_TYPES!r}[k + 1] AS source_type, NOT pk AS nullable, pk AS is_key FROM cols""",
)
def table_schema_query(spark, sf_dir):
    """The schema built from a catalog with one row per column."""
    nation, region = fx.load(spark, sf_dir, "nation"), fx.load(spark, sf_dir, "region")
    kind = F.array(*[F.lit(t) for t in CATALOG_TYPES])[(F.col("n_nationkey") % len(CATALOG_TYPES)).cast("int")]
    columns = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("column_name"),
        kind.alias("type_name"),
        (F.col("r_regionkey") * 100 + F.col("n_nationkey")).alias("position"),
        (F.col("n_nationkey") == 3).alias("primary_key"),
    )
    table = catalog.table_schema(columns)
    keys = catalog.primary_key(table)
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.metadata["type"], f.nullable, f.name in keys) for i, f in enumerate(table.fields)]
    return spark.createDataFrame(rows, "place int, column_name string, spark_type string, source_type string, nullable boolean, is_key boolean")
