"""Column lists: inclusion, masks, and propagated source types.

Lists are comma-separated regular expressions that must match the whole of
``db.table.column``, in any case. They are resolved once, against names; no
data is read for it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructType

from ..config import CdcConfig, split_list
from ..functions.masks import mask_chars, mask_hash, truncate_chars
from ..functions.types import TEXTS, base_type_name
from ..logschema import table_columns


def matching(names: list[str], patterns: str | list[str] | None, prefix: str) -> list[str]:
    """The names for which ``prefix.name`` matches one of the patterns."""
    compiled = [re.compile(p, re.IGNORECASE) for p in split_list(patterns)]
    return [n for n in names if any(p.fullmatch(f"{prefix}.{n}") for p in compiled)]


def selected_columns(
    names: list[str], include: str | None, exclude: str | None, db: str, table: str
) -> list[str]:
    """Columns that stay in the row, in their order."""
    prefix = f"{db}.{table}"
    if include:
        return matching(names, include, prefix)
    dropped = set(matching(names, exclude, prefix))
    return [n for n in names if n not in dropped]


def select_columns(
    df: DataFrame, include: str | None = None, exclude: str | None = None, *, db: str, table: str
) -> DataFrame:
    """Keeps the log's metadata, a ``key`` built before, and the selected table columns.

    The key is not touched, so it keeps every primary-key column.
    """
    own = [c for c in table_columns(df.columns) if c != "key"]
    keep = set(selected_columns(own, include, exclude, db, table))
    return df.select(*[c for c in df.columns if c not in own or c in keep])


def masked(config: CdcConfig, table: StructType) -> dict[str, Column]:
    """The masking expression of every text column that has one. Other types have nothing to mask."""
    prefix = f"{config.db}.{config.table}"
    # By source type: times, geographies and wide decimals are raw text too, but no text columns.
    names = [
        f.name
        for f in table.fields
        if isinstance(f.dataType, StringType) and ("type" not in f.metadata or base_type_name(f.metadata["type"]) in TEXTS)
    ]
    out: dict[str, Column] = {}
    for length, patterns in config.truncate.items():
        for name in matching(names, patterns, prefix):
            out[name] = truncate_chars(name, length)
    for length, patterns in config.mask_chars.items():
        for name in matching(names, patterns, prefix):
            out[name] = mask_chars(name, length)
    for (algorithm, salt), patterns in config.mask_hash.items():
        for name in matching(names, patterns, prefix):
            out[name] = mask_hash(name, algorithm, salt)
    return out


def propagated(table: StructType, config: CdcConfig) -> dict[str, dict[str, str]]:
    """Source type facts for the columns that a propagation list names."""
    prefix = f"{config.db}.{config.table}"
    by_column = set(matching(table.names, config.propagate_columns, prefix))
    by_type = [re.compile(p, re.IGNORECASE) for p in split_list(config.propagate_types)]
    out = {}
    for f in table.fields:
        kind = base_type_name(f.metadata.get("type", ""))
        if f.name not in by_column and not any(p.fullmatch(f"{config.db}.{kind}") for p in by_type):
            continue
        facts = {"source.column.type": kind, "source.column.name": f.name}
        for fact in ("length", "scale"):
            if f.metadata.get(fact) is not None:
                facts[f"source.column.{fact}"] = str(f.metadata[fact])
        out[f.name] = facts
    return out


def propagate_type(df: DataFrame, table: StructType, config: CdcConfig) -> DataFrame:
    """Attaches source type, length, scale and name to the matching columns as field metadata."""
    facts = propagated(table, config)
    return df.select(
        *[F.col(c).alias(c, metadata=facts[c]) if c in facts else F.col(c) for c in df.columns]
    )


def describe_types(df: DataFrame) -> DataFrame:
    """Per column that carries source facts: those facts and the number of values in it.

    One aggregate pass; the result has one row per column.
    """
    described = [f for f in df.schema.fields if "source.column.type" in f.metadata]
    counts = df.agg(*[F.count(f.name).alias(f.name) for f in described])
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.metadata["source.column.type"]).alias("source_type"),
                F.lit(f.metadata.get("source.column.length")).cast("string").alias("source_length"),
                F.lit(f.metadata.get("source.column.scale")).cast("string").alias("source_scale"),
                F.col(f.name).alias("n_values"),
            )
            for f in described
        ]
    )
    return counts.select(F.inline(rows))
