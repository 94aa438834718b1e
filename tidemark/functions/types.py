"""Source types: names, numeric conversions, and the table-driven column conversion.

A column's source type travels in its ``StructField.metadata`` (see
``sources.catalog.table_schema``), so conversions are chosen once on the driver
and run as one projection.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F
from pyspark.sql.types import StructField

from ..config import CdcConfig
from .binary import convert_binary, convert_bit
from .geography import EMPTY_COLLECTION, convert_geography, geography_shape
from .offsets import _col
from .temporal import (
    DURATION,
    TIME_MICROS_WIDTH,
    TIME_SECONDS_WIDTH,
    TIMESTAMP_MICROS_WIDTH,
    TIMESTAMP_SECONDS_WIDTH,
    convert_date,
    convert_time,
    convert_timestamp,
    convert_year,
    parse_duration,
)
from .vector import ELEMENT_SPARK, VECTOR_TYPE, convert_vector

# Base type names by the conversion they take.
SMALLINTS = {"BOOL", "BOOLEAN", "TINYINT", "TINYINT UNSIGNED", "SMALLINT"}
INTS = {"MEDIUMINT", "MEDIUMINT UNSIGNED", "INT", "INTEGER", "SMALLINT UNSIGNED"}
# An unsigned type takes the next wider signed one; that of BIGINT UNSIGNED is a decimal.
BIGINTS = {"BIGINT", "INT UNSIGNED", "INTEGER UNSIGNED"}
WIDE_INTS = {"BIGINT UNSIGNED"}
FLOATS = {"FLOAT", "FLOAT UNSIGNED"}
DOUBLES = {"DOUBLE", "DOUBLE UNSIGNED", "REAL"}
DECIMALS = {"DECIMAL", "DEC", "FIXED", "NUMERIC"}
TEXTS = {"CHAR", "VARCHAR", "TINYTEXT", "TEXT", "MEDIUMTEXT", "LONGTEXT", "ENUM", "SET", "JSON"}
BINARIES = {"BINARY", "VARBINARY", "TINYBLOB", "BLOB", "MEDIUMBLOB", "LONGBLOB", "BSON"}
GEOGRAPHIES = {"GEOGRAPHY", "GEOGRAPHYPOINT"}
TIMESTAMPS = {"DATETIME", "TIMESTAMP"}
MAX_PRECISION = 38


def base_type(c: Column | str) -> Column:
    """Upper-cased type name, cut before the first bracket."""
    return F.substring_index(F.upper(_col(c)), "(", 1)


def base_type_name(name: str) -> str:
    """:func:`base_type` for a name known on the driver."""
    return name.upper().split("(", 1)[0]


def to_smallint(c: Column | str) -> Column:
    return _col(c).cast("smallint")


def to_int(c: Column | str) -> Column:
    return _col(c).cast("int")


def to_float(c: Column | str) -> Column:
    return _col(c).cast("float")


def keep_text(c: Column | str) -> Column:
    """JSON, ENUM and SET text, kept byte for byte."""
    return _col(c)


def convert_decimal(c: Column | str, mode: str = "precise", precision: int = 10, scale: int = 0) -> Column:
    """``precise``: decimal while Spark can hold it, else text; ``double``; ``string``."""
    value = _col(c)
    if mode == "double":
        return value.cast("double")
    if mode == "string":
        return value.cast("string")
    if mode == "precise":
        return value.cast(f"decimal({precision},{scale})" if precision <= MAX_PRECISION else "string")
    raise ValueError(f"unknown decimal mode {mode}")


def null_fallback(c: Column | str, type_name: str, nullable: bool, config: CdcConfig | None = None) -> Column:
    """A converted value, or the type's stand-in when NOT NULL holds no value."""
    value = _col(c)
    if nullable:
        return value
    base = base_type_name(type_name)
    binary_mode = config.binary_mode if config else "bytes"
    vector_mode = config.vector_mode if config else "string"
    if base == "YEAR":
        return F.coalesce(value, F.lit(0))
    if base == "TIME":
        return F.coalesce(value, F.lit(0).cast("bigint"))
    if base in BINARIES and base not in ("BINARY", "VARBINARY"):
        return F.coalesce(value, convert_binary(F.unhex(F.lit("")), binary_mode))
    if base == "VECTOR":
        element = vector_element(type_name)
        if vector_mode == "array":
            return F.coalesce(value, F.array().cast(f"array<{ELEMENT_SPARK[element]}>"))
        if vector_mode == "binary":
            return F.coalesce(value, convert_binary(F.unhex(F.lit("")), binary_mode))
        return F.coalesce(value, F.lit("[]"))
    if base in GEOGRAPHIES and (config is None or config.geography_mode == "geometry"):
        empty = F.struct(F.lit(None).cast("int").alias("srid"), F.unhex(F.lit(EMPTY_COLLECTION)).alias("wkb"))
        return F.coalesce(value, empty)
    return value


def vector_element(type_name: str) -> str:
    """The element type in a VECTOR type name."""
    found = re.match(VECTOR_TYPE, type_name.upper())
    if not found:
        raise ValueError(f"invalid VECTOR type: {type_name}")
    return found[2]


# Column metadata that names what a whole number stands for.
SEMANTIC = "semantic"


def semantic_type(field: StructField, config: CdcConfig) -> dict[str, str]:
    """The name of what a temporal column's number counts, under the job's prefix for such names; none without a prefix."""
    base = base_type_name(field.metadata.get("type", ""))
    arguments = type_arguments(field.metadata.get("type", ""))
    length = int(field.metadata.get("length", 0) or 0)
    if not config.semantic_prefix or config.time_mode == "connect":
        return {}
    if base == "DATE":
        name = "Date"
    elif base == "TIME":
        wide = TIME_SECONDS_WIDTH < (length or (TIME_MICROS_WIDTH if arguments == [6] else TIME_SECONDS_WIDTH)) <= TIME_MICROS_WIDTH
        name = "MicroTime" if wide or config.time_mode == "adaptive_time_microseconds" else "Time"
    elif base in TIMESTAMPS:
        size = length or (TIMESTAMP_MICROS_WIDTH if arguments == [6] else TIMESTAMP_SECONDS_WIDTH)
        name = "Timestamp" if size <= TIMESTAMP_SECONDS_WIDTH else "MicroTimestamp"
    else:
        return {}
    return {SEMANTIC: f"{config.semantic_prefix}.{name}"}


def type_arguments(type_name: str) -> list[int]:
    """The whole numbers between the brackets of a type name."""
    inside = re.search(r"\(([^)]*)\)", type_name)
    return [int(n) for n in re.findall(r"\d+", inside[1])] if inside else []


def _target(base: str, arguments: list[int], config: CdcConfig) -> str | None:
    """The Spark type a plain conversion casts to; None for types with a conversion of their own."""
    for types, target in ((SMALLINTS, "smallint"), (INTS, "int"), (BIGINTS, "bigint"), (FLOATS, "float"), (DOUBLES, "double")):
        if base in types:
            return target
    if base in WIDE_INTS:
        return "decimal(20,0)"
    if base in DECIMALS:
        precision, scale = (arguments + [10, 0][len(arguments) :])[:2]
        fits = config.decimal_mode == "precise" and precision <= MAX_PRECISION
        return f"decimal({precision},{scale})" if fits else "double" if config.decimal_mode == "double" else None
    return {"YEAR": "int", "DATE": "date"}.get(base, "timestamp" if base in TIMESTAMPS else None)


def readable(field: StructField, config: CdcConfig) -> Column | None:
    """Whether a column's value can be converted; None for types whose values always can."""
    name = field.metadata.get("type", "")
    base = base_type_name(name)
    raw = field.dataType.simpleString()
    value = F.col(field.name)
    if base == "TIME" and raw == "string":
        return value.isNull() | value.rlike(DURATION)
    if base in GEOGRAPHIES and config.geography_mode == "geometry":
        return value.isNull() | geography_shape(value).isNotNull()
    if base == "VECTOR" and raw.startswith("array") and config.vector_mode == "binary":
        return value.isNull() | ~F.exists(value, lambda x: x.isNull())
    target = _target(base, type_arguments(name), config)
    # A raw column of the target's own type, or of a narrower whole number, always converts.
    whole = ["tinyint", "smallint", "int", "bigint"]
    safe = raw == target or (raw in whole and target in whole and whole.index(raw) <= whole.index(target))
    if target is None or safe or raw in ("date", "timestamp") or (raw in ("float", "double") and target in ("float", "double")):
        return None
    return value.isNull() | value.try_cast(target).isNotNull()


def convert_column(field: StructField, config: CdcConfig, c: Column | None = None) -> Column:
    """One table column in the form its source type and the job's modes ask for."""
    value = F.col(field.name) if c is None else c
    name = field.metadata.get("type")
    if name is None:
        return value
    base = base_type_name(name)
    length = int(field.metadata.get("length", 0) or 0)
    arguments = type_arguments(name)
    if base in SMALLINTS:
        out = to_smallint(value)
    elif base in INTS:
        out = to_int(value)
    elif base in BIGINTS:
        out = value.cast("bigint")
    elif base in WIDE_INTS:
        out = value.cast("decimal(20,0)")
    elif base in FLOATS:
        out = to_float(value)
    elif base in DOUBLES:
        out = value.cast("double")
    elif base in DECIMALS:
        precision, scale = (arguments + [10, 0][len(arguments):])[:2]
        out = convert_decimal(value, config.decimal_mode, precision, scale)
    elif base == "BIT":
        out = convert_bit(value)
    elif base == "DATE":
        out = convert_date(value, config.time_mode)
    elif base == "TIME":
        micros = parse_duration(value, strict=False) if field.dataType.typeName() == "string" else value.cast("bigint")
        out = convert_time(micros, config.time_mode, length or (17 if arguments == [6] else 10))
    elif base in TIMESTAMPS:
        out = convert_timestamp(value, config.time_mode, length or (26 if arguments == [6] else 19))
    elif base == "YEAR":
        out = convert_year(value, "date" if field.dataType.typeName() == "date" else "number")
    elif base in TEXTS:
        out = keep_text(value)
    elif base in BINARIES:
        out = convert_binary(value, config.binary_mode)
    elif base in GEOGRAPHIES:
        out = convert_geography(value, config.geography_mode, field.nullable, base == "GEOGRAPHYPOINT")
    elif base == "VECTOR":
        out = convert_vector(value, vector_element(name), config.vector_mode, config.binary_mode)
    else:
        out = value
    # The geography conversion tells a missing value from an unreadable one itself.
    return out if base in GEOGRAPHIES else null_fallback(out, name, field.nullable, config)
