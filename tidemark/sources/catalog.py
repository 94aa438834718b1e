"""Facts about the captured table and its database."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..functions.types import (
    BIGINTS,
    BINARIES,
    DECIMALS,
    DOUBLES,
    FLOATS,
    INTS,
    MAX_PRECISION,
    SMALLINTS,
    TIMESTAMPS,
    WIDE_INTS,
    base_type_name,
    type_arguments,
    vector_element,
)
from ..functions.vector import ELEMENT_SPARK


def raw_type(type_name: str) -> DataType:
    """The Spark type in which the raw log holds a source type."""
    base = base_type_name(type_name)
    if base in SMALLINTS:
        ddl = "smallint"
    elif base in INTS or base == "YEAR":
        ddl = "int"
    elif base in BIGINTS:
        ddl = "bigint"
    elif base in WIDE_INTS:
        ddl = "decimal(20,0)"
    elif base in FLOATS:
        ddl = "float"
    elif base in DOUBLES:
        ddl = "double"
    elif base in DECIMALS:
        precision, scale = (type_arguments(type_name) + [10, 0][len(type_arguments(type_name)):])[:2]
        ddl = f"decimal({precision},{scale})" if precision <= MAX_PRECISION else "string"
    elif base in BINARIES or base == "BIT":
        ddl = "binary"
    elif base == "DATE":
        ddl = "date"
    elif base in TIMESTAMPS:
        ddl = "timestamp"
    elif base == "VECTOR":
        ddl = f"array<{ELEMENT_SPARK[vector_element(type_name)]}>"
    else:
        ddl = "string"
    return DataType.fromDDL(ddl)


def table_schema(columns: DataFrame) -> StructType:
    """The table's schema from one row per column.

    ``columns`` has ``column_name, type_name, position`` and, where known,
    ``nullable, length, scale, default, primary_key, auto_increment``; a table's
    columns, so a handful of rows. All facts go into ``StructField.metadata``.
    Unique indexes do not make a key. An auto-increment INT is a BIGINT.
    """
    known = set(columns.columns)
    fields = []
    for row in columns.orderBy("position").toLocalIterator():
        facts = row.asDict()
        name = facts["type_name"]
        if facts.get("auto_increment") and base_type_name(name) in INTS:
            name = "BIGINT"
        meta: dict[str, object] = {"type": name, "position": int(facts["position"])}
        for fact in ("length", "scale", "default", "primary_key", "auto_increment"):
            if fact in known and facts[fact] is not None:
                meta[fact] = facts[fact]
        nullable = bool(facts.get("nullable", True)) and not facts.get("primary_key")
        fields.append(StructField(facts["column_name"], raw_type(name), nullable, meta))
    return StructType(fields)


def primary_key(table: StructType) -> list[str]:
    """Primary-key columns in table order; empty when the table has none."""
    return [f.name for f in table.fields if f.metadata.get("primary_key")]


def partition_count(offsets_df: DataFrame, column: str = "num_partitions") -> DataFrame:
    """One row ``partitions``: the database's partition count, 1 when unknown, an error below 1."""
    count = F.coalesce(F.max(column).cast("int"), F.lit(1))
    problem = F.raise_error(F.lit("the number of partitions must be at least 1")).cast("int")
    return offsets_df.agg(count.alias("__count")).select(
        F.when(F.col("__count") >= 1, F.col("__count")).otherwise(problem).alias("partitions")
    )
