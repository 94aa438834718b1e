"""Events out: topics, messages, tombstones, writing."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from ..functions.types import SEMANTIC
from ..logschema import INTERNAL_ID

# Fixed value: what a message would say of its transaction.
TRANSACTION = "struct<id:string,total_order:bigint,data_collection_order:bigint>"
VALUE_FIELDS = ("before", "after", "source", "op", "ts_ms")


def topic_name(
    prefix: Column | str, db: Column | str, table: Column | str, delimiter: str = ".", strategy: str = "default"
) -> Column:
    """``prefix.db.table``; strategy ``unicode`` writes an underscore inside a part as ``_u005f``."""
    parts = [p if isinstance(p, Column) else F.lit(p) for p in (prefix, db, table)]
    if strategy == "unicode":
        parts = [F.replace(p, F.lit("_"), F.lit("_u005f")) for p in parts]
    elif strategy != "default":
        raise ValueError(f"unknown topic strategy {strategy}")
    return F.concat_ws(delimiter, *parts)


# Type names in a message's schema part.
_SCHEMA_TYPES: list[tuple[type[DataType], str]] = [
    (BooleanType, "boolean"),
    (ByteType, "int8"),
    (ShortType, "int16"),
    (IntegerType, "int32"),
    (LongType, "int64"),
    (FloatType, "float"),
    (DoubleType, "double"),
    (StringType, "string"),
    (BinaryType, "bytes"),
    (DateType, "int32"),
    (TimestampType, "int64"),
    (TimestampNTZType, "int64"),
    (DecimalType, "bytes"),
]
# Names of the types whose payload is an encoded number, and of their parameters.
_LOGICAL = "org.apache.kafka.connect.data."
_LOGICAL_TYPES: list[tuple[type[DataType], str]] = [
    (DateType, "Date"),
    (TimestampType, "Timestamp"),
    (TimestampNTZType, "Timestamp"),
    (DecimalType, "Decimal"),
]
SCALE, PRECISION = "scale", "connect.decimal.precision"


def message_schema(kind: DataType, optional: bool, name: str | None = None) -> dict:
    """The schema part of a message, as nested plain values."""
    if isinstance(kind, StructType):
        fields = [{**message_schema(f.dataType, f.nullable), "field": f.name} for f in kind.fields]
        for entry, f in zip(fields, kind.fields):
            facts = {k: v for k, v in f.metadata.items() if k.startswith("source.column.")}
            if facts:
                entry["parameters"] = {**entry.get("parameters", {}), **facts}
            if SEMANTIC in f.metadata and "name" not in entry:
                entry.update(name=f.metadata[SEMANTIC], version=1)
        out: dict = {"type": "struct", "fields": fields}
    elif isinstance(kind, ArrayType):
        out = {"type": "array", "items": message_schema(kind.elementType, kind.containsNull)}
    else:
        out = {"type": next((n for t, n in _SCHEMA_TYPES if isinstance(kind, t)), "string")}
    out["optional"] = optional
    logical = next((n for t, n in _LOGICAL_TYPES if isinstance(kind, t)), None)
    if logical:
        out.update(name=_LOGICAL + logical, version=1)
    if isinstance(kind, DecimalType):
        out["parameters"] = {SCALE: str(kind.scale), PRECISION: str(kind.precision)}
    if name:
        out["name"] = name
    return out


_WORD = str(1 << 64)


def unscaled_bytes(c: Column, kind: DecimalType) -> Column:
    """A decimal's digits without the point, as the fewest big-endian bytes in two's complement."""
    digits = F.replace(c.cast(kind).cast("string"), F.lit("."), F.lit(""))
    if kind.precision <= 18:
        text = F.lpad(F.hex(digits.cast("bigint")), 16, "0")
    else:
        number = digits.cast("decimal(38,0)")
        low = F.pmod(number, F.lit(_WORD).cast("decimal(20,0)")).cast("decimal(20,0)")
        word = F.lit(_WORD).cast("decimal(38,0)")
        high = F.call_function("div", number, word) - F.when((number < 0) & (low > 0), F.lit(1)).otherwise(F.lit(0))
        half = F.lit(1 << 32).cast("decimal(20,0)")
        upper = F.call_function("div", low, half)
        lower = F.pmod(low, half).cast("bigint")
        text = F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(upper), 8, "0"), F.lpad(F.hex(lower), 8, "0"))
    # A leading byte goes if the next one has the same sign.
    short = F.regexp_replace(F.regexp_replace(text, "^(?:00(?=[0-7]))+", ""), "^(?:FF(?=[89A-F]))+", "")
    return F.unhex(short)


def payload_value(c: Column, kind: DataType) -> Column:
    """A value in the form its schema promises: decimals as bytes, dates as days, timestamps as milliseconds."""
    if isinstance(kind, StructType):
        if not _encoded(kind):
            return c
        fields = [payload_value(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: payload_value(x, kind.elementType)) if _encoded(kind) else c
    if isinstance(kind, DecimalType):
        return unscaled_bytes(c, kind)
    if isinstance(kind, DateType):
        return F.unix_date(c)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_millis(c.cast("timestamp"))
    return c


def _encoded(kind: DataType) -> bool:
    """Whether a type holds any value that a message writes in another form."""
    if isinstance(kind, StructType):
        return any(_encoded(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _encoded(kind.elementType)
    return isinstance(kind, (DecimalType, DateType, TimestampType, TimestampNTZType))


def _message(payload: Column, kind: DataType, schema: dict) -> Column:
    text = F.to_json(payload_value(payload, kind), {"ignoreNullFields": "false"})
    head = '{"schema":' + json.dumps(schema, separators=(",", ":")) + ',"payload":'
    return F.concat(F.lit(head), text, F.lit("}"))


def with_value(df: DataFrame) -> DataFrame:
    """Event columns gathered into one ``value`` struct."""
    own = [c for c in df.columns if c not in VALUE_FIELDS]
    return df.select(*own, F.struct(*VALUE_FIELDS).alias("value"))


def with_tombstones(df: DataFrame, enabled: bool = True) -> DataFrame:
    """Each delete is followed by a row with the same key and a null value.

    Rows get ``is_tombstone``; order by ``(seq, is_tombstone)``.
    """
    whole = df if "value" in df.columns else with_value(df)
    if not enabled:
        return whole.withColumn("is_tombstone", F.lit(False))
    own = [c for c in whole.columns if c != "value"]
    kind = whole.schema["value"].dataType
    real = F.struct(F.col("value").alias("value"), F.lit(False).alias("is_tombstone"))
    tomb = F.struct(F.lit(None).cast(kind).alias("value"), F.lit(True).alias("is_tombstone"))
    rows = F.when(F.col("value.op") == "d", F.array(real, tomb)).otherwise(F.array(real))
    return whole.select(*own, F.inline(rows))


# What every message has; all else may be missing.
_ALWAYS = ("version", "connector", "name", "ts_ms", "db", "table", "txId", "partitionId", "offsets")


def _with_table_facts(schema: dict, table: StructType | None) -> dict:
    """Marks what is required: the table's columns that are, and the fixed parts. A frame read from files knows neither."""
    required = {f.name for f in table.fields if not f.nullable} if table is not None else set()
    for side in schema["fields"]:
        side["optional"] = side["field"] not in ("source", "op")
        if side["field"] == "source":
            for f in side["fields"]:
                f["optional"] = f["field"] not in _ALWAYS
        if side["field"] in ("before", "after"):
            for f in side["fields"]:
                f["optional"] = f["field"] not in required and f["field"] != INTERNAL_ID
    return schema


def to_messages(df: DataFrame, name: str = "", table: StructType | None = None) -> DataFrame:
    """Key and value as self-contained ``{schema, payload}`` JSON text. A tombstone keeps a null value.

    The schema part is built once, from the frame's schema and the table's;
    rows only serialize their payload. The log has no transaction facts, so
    that field is always null.
    """
    whole = df if "value" in df.columns else with_value(df)
    whole = whole.withColumn(
        "value", F.when(F.col("value").isNotNull(), F.col("value").withField("transaction", F.lit(None).cast(TRANSACTION)))
    )
    key_schema = message_schema(whole.schema["key"].dataType, False, f"{name}.Key" if name else None)
    for f in key_schema["fields"]:
        f["optional"] = False
    value_schema = message_schema(whole.schema["value"].dataType, False, f"{name}.Envelope" if name else None)
    value_schema = _with_table_facts(value_schema, table)
    rest = [c for c in whole.columns if c not in ("key", "value")]
    kinds = {f.name: f.dataType for f in whole.schema.fields}
    return whole.select(
        *rest,
        _message(F.col("key"), kinds["key"], key_schema).alias("key"),
        _message(F.col("value"), kinds["value"], value_schema).alias("value"),
    )


def keyed_order(messages: DataFrame) -> DataFrame:
    """Messages with each key of a topic in one task, in ``(seq, is_tombstone)`` order, as a keyed log must get them."""
    dealt = messages.repartition("topic", "key")
    return dealt.sortWithinPartitions(*[c for c in ("seq", "is_tombstone") if c in messages.columns])


def write_events(
    df: DataFrame,
    path: str | None = None,
    *,
    kafka: dict[str, str] | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    total_order: bool = False,
) -> None:
    """Every event to its topic: one folder per topic, or the Kafka topic itself.

    Files are sorted by ``seq`` inside; the vector step already groups
    neighbouring events, so this needs no shuffle. ``total_order`` range
    partitions by ``seq`` first, so that files also follow each other, and
    splits a topic of any size over many tasks.
    """
    if kafka is not None:
        messages = df if dict(df.dtypes).get("value") == "string" else to_messages(df)
        keyed_order(messages).select("topic", "key", "value").write.format("kafka").options(**kafka).save()
        return
    order = [c for c in ("topic", "seq", "is_tombstone") if c in df.columns]
    out = df.repartitionByRange(*order) if total_order else df
    out = out.sortWithinPartitions(*order)
    out.write.mode(mode).partitionBy("topic").format(fmt).save(path)
