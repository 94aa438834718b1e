"""The composed scan: fields, tables, format, target, start and filter, in that order of clauses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..logschema import META_COLUMNS
from ..operators.offsets import begin_at

# Catalogs of the server itself, compared in any case.
SYSTEM_CATALOGS = ("information_schema", "cluster", "memsql")


def table_filter(df: DataFrame, db: str, table: str, *, db_col: str = "db", table_col: str = "Table") -> DataFrame:
    """Exact match on database and table; system catalogs and a null catalog never pass."""
    catalog = F.col(db_col)
    return df.where(
        catalog.isNotNull()
        & ~F.lower(catalog).isin(*SYSTEM_CATALOGS)
        & (catalog == db)
        & (F.col(table_col) == table)
    )


def observe(
    df: DataFrame,
    fields: list[str] | None = None,
    tables: list[str] | None = None,
    fmt: str | None = None,
    into: str | None = None,
    begin_at_offsets: list[str | None] | None = None,
    where: str | Column | None = None,
) -> DataFrame:
    """A scan of the log with optional clauses.

    ``fields``: table columns to keep (metadata always stays); ``tables``:
    names to keep; ``fmt`` ``JSON``: one text column ``record``; ``into``: a
    folder to write to as well; ``begin_at_offsets``: start vector; ``where``:
    a filter on metadata or content.
    """
    out = df
    if tables:
        out = out.where(F.col("Table").isin(*tables))
    if begin_at_offsets:
        out = begin_at(out, begin_at_offsets)
    if where is not None:
        out = out.where(where)
    if fields:
        meta = [c for c in META_COLUMNS if c in df.columns]
        out = out.select(*meta, *[c for c in fields if c not in meta])
    kind = (fmt or "SQL").upper()
    if kind not in ("SQL", "JSON"):
        raise ValueError(f"unknown output format {fmt}")
    if kind == "JSON":
        out = out.select(F.to_json(F.struct(*out.columns), {"ignoreNullFields": "false"}).alias("record"))
    if into:
        out.write.mode("errorifexists").format("json" if kind == "SQL" else "text").save(into)
        return df.sparkSession.read.format("json" if kind == "SQL" else "text").schema(
            out.schema if kind == "SQL" else "record string"
        ).load(into)
    return out
