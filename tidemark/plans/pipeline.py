"""The capture pipeline: a raw change log in, events out, as one logical plan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from ..config import CdcConfig
from ..functions.events import ts_ms as processing_time
from ..functions.offsets import to_hex
from ..functions.types import convert_column, readable, semantic_type
from ..hooks import Hooks
from ..operators.columns import masked, propagated, selected_columns
from ..operators.envelope import (
    after_column,
    drop_markers,
    envelope,
    key_column,
    map_op,
    skip_operations,
    source_struct,
)
from ..operators.offsets import with_offset_vector
from ..operators.sinks import topic_name, with_tombstones, with_value
from ..operators.snapshot import mark_first, snapshot_rows
from ..sources.catalog import primary_key


def row_columns(table: StructType, config: CdcConfig, hooks: Hooks) -> list[Column]:
    """The ``after`` fields: selected, converted, masked, with propagated facts."""
    masks = masked(config, table)
    facts = propagated(table, config)
    keep = selected_columns(table.names, config.column_include, config.column_exclude, config.db, config.table)
    columns = []
    for f in table.fields:
        if f.name not in keep:
            continue
        custom = hooks.converter_for(f.name, config)
        own = dict(facts.get(f.name, {}))
        if f.name in masks:
            value = masks[f.name]
        elif custom:
            value = custom(F.col(f.name))
        else:
            value = convert_column(f, config)
            own.update(semantic_type(f, config))
        columns.append(value.alias(f.name, metadata=own) if own else value.alias(f.name))
    return columns


def readable_row(table: StructType, config: CdcConfig, hooks: Hooks | None = None) -> Column | None:
    """Whether a record's columns can be converted; None when every record's can.

    Judged are the key's columns, and the columns that stay in the row and take the
    built-in conversion; an excluded, masked or custom-converted one is not.
    """
    hooks = hooks or Hooks()
    masks = masked(config, table)
    keep = selected_columns(table.names, config.column_include, config.column_exclude, config.db, config.table)
    built_in = {c for c in keep if c not in masks and not hooks.converter_for(c, config)}
    judged = built_in | set(primary_key(table) or ())
    checks = [c for c in (readable(f, config) for f in table.fields if f.name in judged) if c is not None]
    return reduce(lambda a, b: a & b, checks) if checks else None


def rejected_records(
    log: DataFrame, table: StructType, config: CdcConfig, *, snapshot: bool = False, hooks: Hooks | None = None
) -> DataFrame:
    """Raw records that the failure modes ``warn`` and ``ignore`` skip."""
    good = readable_row(table, config, hooks)
    if good is None:
        return log.limit(0)
    return (snapshot_rows(log, config.partitions) if snapshot else drop_markers(log)).where(~good)


def _apply_failure_mode(rows: DataFrame, table: StructType, config: CdcConfig, hooks: Hooks) -> DataFrame:
    good = readable_row(table, config, hooks)
    if good is None:
        return rows
    if config.failure_mode == "fail":
        place = F.concat(F.lit("cannot convert the record at "), to_hex("Offset"))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(place).cast("boolean"))
    return rows.where(good)


def cdc_events(
    log: DataFrame,
    table: StructType,
    config: CdcConfig,
    *,
    snapshot: bool = False,
    start: list[str | None] | None = None,
    records: int | None = None,
    ts_ms: Column | None = None,
    hooks: Hooks | None = None,
) -> DataFrame:
    """Events ``seq, topic, key, before, after, source, op, ts_ms`` of one log.

    ``records`` is how many data records the log has, if known. The vector is
    attached before operations are skipped, because a skipped event still
    moves it.
    """
    hooks = hooks or Hooks()
    pk = primary_key(table)
    moment = ts_ms if ts_ms is not None else processing_time()
    rows = mark_first(snapshot_rows(log, config.partitions)) if snapshot else drop_markers(log)
    rows = with_offset_vector(rows, config.partitions, start, records=records, bucket_rows=config.bucket_rows)
    rows = map_op(_apply_failure_mode(rows, table, config, hooks), snapshot)
    rows = rows if snapshot else skip_operations(rows, config.skipped_operations)
    source = source_struct(config, ts_ms=moment, snapshot=F.col("snapshot") if snapshot else "false", strict=True)
    if hooks.source:
        source = hooks.source(source)
    topic = hooks.topic(config) if hooks.topic else topic_name(
        config.topic_prefix, config.db, config.table, config.topic_delimiter, config.topic_strategy
    )
    by_name = {f.name: f for f in table.fields}
    key = F.struct(*[convert_column(by_name[c], config).alias(c) for c in pk]) if pk else key_column(None)
    rows = rows.withColumn("topic", topic).withColumn("key", key)
    row = after_column(row_columns(table, config, hooks), config.populate_internal_id)
    return hooks.process(envelope(rows, row, source, moment, ["topic"]))


def cdc_records(events: DataFrame, config: CdcConfig) -> DataFrame:
    """Events as key and value rows, deletes followed by tombstones when the job has them."""
    return with_tombstones(with_value(events), config.tombstones)
