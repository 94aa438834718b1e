"""From change-log records to keyed events with before, after, source, op and ts_ms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..config import CdcConfig, split_list
from ..functions.offsets import to_hex
from ..logschema import CHANGES, DELETE, INSERT, INTERNAL_ID, META_COLUMNS, UPDATE, table_columns

CREATED, UPDATED, DELETED, READ = "c", "u", "d", "r"


def split_meta(df: DataFrame) -> DataFrame:
    """Two structs: ``meta`` with the log's columns and ``row`` with the table's, found by name."""
    own = [c for c in META_COLUMNS if c in df.columns]
    return df.select(F.struct(*own).alias("meta"), F.struct(*table_columns(df.columns)).alias("row"))


def op_code(kind: Column | str = "Type") -> Column:
    """The operation letter of a streamed record kind; null for markers."""
    c = F.col(kind) if isinstance(kind, str) else kind
    return F.when(c == INSERT, CREATED).when(c == UPDATE, UPDATED).when(c == DELETE, DELETED)


def map_op(df: DataFrame, snapshot: bool = False, out: str = "op") -> DataFrame:
    """Adds the operation letter: c, u, d by kind, or r for every row of a snapshot."""
    return df.withColumn(out, F.lit(READ) if snapshot else op_code())


def drop_markers(df: DataFrame) -> DataFrame:
    """Keeps inserts, updates and deletes. Markers never move the offset vector."""
    return df.where(F.col("Type").isin(*CHANGES))


def skip_operations(df: DataFrame, ops: str | list[str] = "t") -> DataFrame:
    """Drops events by operation letter; ``none`` drops nothing. Runs after the vector was attached."""
    skipped = [o for o in split_list(ops) if o != "none"]
    return df.where(~F.col("op").isin(*skipped)) if skipped else df


def key_column(pk: list[str] | None) -> Column:
    """The key struct: primary-key columns in table order, or the internal id in hex."""
    return F.struct(*pk) if pk else F.struct(to_hex("InternalId").alias(INTERNAL_ID))


def event_key(df: DataFrame, pk: list[str] | None = None, out: str = "key") -> DataFrame:
    """Adds the event's key."""
    return df.withColumn(out, key_column(pk))


def after_column(columns: list[Column | str], populate_internal_id: bool = False) -> Column:
    """The new-row struct, with the internal id as its last field when asked for."""
    extra = [to_hex("InternalId").alias(INTERNAL_ID)] if populate_internal_id else []
    return F.struct(*columns, *extra)


def with_internal_id(df: DataFrame, populate: bool = False, row: str = "after") -> DataFrame:
    """Adds ``internalId`` as the last field of the row struct."""
    if not populate:
        return df
    return df.withColumn(row, F.col(row).withField(INTERNAL_ID, to_hex("InternalId")))


def source_struct(
    config: CdcConfig,
    *,
    ts_ms: Column,
    snapshot: Column | str = "false",
    offsets: Column | str = "offsets",
    strict: bool = False,
) -> Column:
    """Where an event came from. ``strict`` raises on a null transaction id or a partition out of range."""

    def required(c: Column, name: str) -> Column:
        if not strict:
            return c
        problem = F.raise_error(F.lit(f"source field {name} must not be null")).cast("string")
        return F.when(c.isNotNull(), c).otherwise(problem)

    marker = F.lit(snapshot) if isinstance(snapshot, str) else snapshot
    vector = F.col(offsets) if isinstance(offsets, str) else offsets
    partition = F.col("PartitionId").cast("int")
    if strict:
        inside = partition.between(0, config.partitions - 1)
        problem = F.raise_error(F.lit(f"PartitionId must be in 0..{config.partitions - 1}")).cast("int")
        partition = F.when(inside, partition).otherwise(problem)
    return F.struct(
        F.lit(config.connector_version).alias("version"),
        F.lit(config.connector_name).alias("connector"),
        F.lit(config.topic_prefix).alias("name"),
        ts_ms.alias("ts_ms"),
        marker.alias("snapshot"),
        F.lit(config.db).alias("db"),
        F.lit(None).cast("string").alias("sequence"),
        F.lit(config.table).alias("table"),
        required(to_hex("TxId"), "txId").alias("txId"),
        partition.alias("partitionId"),
        vector.alias("offsets"),
    )


def create_event(after: Column) -> tuple[Column, Column]:
    """``(before, after)`` of an insert: the new row alone."""
    return _nothing(after), after


def update_event(after: Column) -> tuple[Column, Column]:
    """``(before, after)`` of an update: the full new row; the log holds no old one."""
    return _nothing(after), after


def read_event(after: Column) -> tuple[Column, Column]:
    """``(before, after)`` of a snapshot row."""
    return _nothing(after), after


def delete_event(after: Column) -> tuple[Column, Column]:
    """``(before, after)`` of a delete: nothing on either side."""
    return _nothing(after), _nothing(after)


def _nothing(like: Column) -> Column:
    """A null with the type of another column."""
    return F.when(F.lit(False), like)


def row_sides(op: Column, row: Column) -> tuple[Column, Column]:
    """``(before, after)`` for a column of mixed operations, in one projection."""
    before, kept = update_event(row)
    return before, F.when(op != DELETED, kept)


def envelope(df: DataFrame, row: Column, source: Column, ts_ms: Column, extra: list[str] | None = None) -> DataFrame:
    """Event rows from records that carry ``op`` and ``key``."""
    before, after = row_sides(F.col("op"), row)
    return df.select(
        "seq",
        *(extra or []),
        "key",
        before.alias("before"),
        after.alias("after"),
        source.alias("source"),
        "op",
        ts_ms.alias("ts_ms"),
    )


def drop_unchanged_updates(df: DataFrame) -> DataFrame:
    """Drops updates whose two sides are equal. An unknown side equals nothing."""
    same = (F.col("op") == UPDATED) & F.col("after").isNotNull() & F.col("after").eqNullSafe(F.col("before"))
    return df.where(~same)


def drop_empty(df: DataFrame, enabled: bool = False) -> DataFrame:
    """Option: drops creates and updates without a new row and deletes without an old one."""
    if not enabled:
        return df
    side = F.when(F.col("op") == DELETED, F.col("before").isNotNull()).otherwise(F.col("after").isNotNull())
    return df.where(side)


def failure_mode(
    df: DataFrame, attempts: dict[str, tuple[Column, Column]], mode: str = "fail"
) -> tuple[DataFrame, DataFrame]:
    """Applies conversions that may fail: returns ``(good rows, rejected rows)``.

    ``attempts`` maps a new column to ``(input, converted)``, the conversion
    giving null where it cannot read the input. ``fail`` raises on the first
    such row; ``warn`` hands the rows back for a side table; ``ignore`` only
    drops them.
    """
    bad = F.lit(False)
    for raw, converted in attempts.values():
        bad = bad | (raw.isNotNull() & converted.isNull())
    values = {name: converted for name, (_, converted) in attempts.items()}
    if mode == "fail":
        for name, (raw, converted) in attempts.items():
            problem = F.raise_error(F.concat(F.lit(f"cannot convert {name}: "), raw.cast("string")))
            # A filter is not pruned away with an unused column, so the check always runs.
            df = df.where(F.when(raw.isNotNull() & converted.isNull(), problem.cast("boolean")).otherwise(F.lit(True)))
        return df.withColumns(values), df.limit(0)
    if mode not in ("warn", "ignore"):
        raise ValueError(f"unknown failure mode {mode}")
    rejected = df.where(bad) if mode == "warn" else df.limit(0)
    return df.where(~bad).withColumns(values), rejected
