"""The raw change log: its metadata columns and record kinds."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Record kinds of the change log.
BEGIN_SNAPSHOT = "BeginSnapshot"
COMMIT_SNAPSHOT = "CommitSnapshot"
BEGIN_TRANSACTION = "BeginTransaction"
COMMIT_TRANSACTION = "CommitTransaction"
INSERT = "Insert"
UPDATE = "Update"
DELETE = "Delete"
CHANGES = (INSERT, UPDATE, DELETE)

# The log's own order is its arrival order. A DataFrame has none, so every
# record carries a unique arrival number.
SEQ = "seq"

META = StructType(
    [
        StructField(SEQ, LongType(), False),
        StructField("Offset", BinaryType()),
        StructField("PartitionId", IntegerType()),
        StructField("Type", StringType()),
        StructField("Table", StringType()),
        StructField("TxId", BinaryType()),
        StructField("TxPartitions", StringType()),
        StructField("InternalId", BinaryType()),
    ]
)
META_COLUMNS = tuple(META.names)
INTERNAL_ID = "internalId"


def raw_log_schema(table: StructType) -> StructType:
    """Schema of the raw log of one table: the metadata, then the table's columns."""
    return StructType([*META.fields, *table.fields])


def table_columns(names: list[str]) -> list[str]:
    """The table's own columns, found by name."""
    return [n for n in names if n not in META_COLUMNS]
