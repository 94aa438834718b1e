"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

DataFrame functions only. The texts are shuffled once, folded before that inside
each input split, so a group that holds a third of all rows arrives as one row per
split. Grouping by ``(hash, text)`` is the comparison of bytes: two texts under
one hash stay two groups. Ids then meet their group on hashes alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, free_names, text_or_empty

Normalise = Callable[[Column], Column]


def one_space(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, f"[{SPACE}]+", " ")


def _hashes(docs: DataFrame, id_col: str, text_col: str, normalise: Normalise) -> DataFrame:
    # Named columns first: whatever else the documents carry cannot clash.
    rows = docs.select(F.col(id_col).alias("id"), normalise(text_or_empty(text_col)).alias("t"))
    return rows.select("id", "t", F.unhex(F.md5("t")).alias("h"), F.unhex(F.sha2("t", 256)).alias("s"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Normalise = one_space) -> DataFrame:
    """One row per distinct text: ``h``, ``s`` (its hashes), ``keep_id``, ``group_size``."""
    texts = _hashes(docs, id_col, text_col, normalise).groupBy("h", "t")
    groups = texts.agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return groups.select("h", F.unhex(F.sha2("t", 256)).alias("s"), "keep_id", "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Normalise = one_space) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Null texts count as empty, and empty texts form a group like any other. Null
    ids come after all others: they stay only where the whole group has none. Of
    rows that tie on the smallest id exactly one is kept. An empty table gives no
    rows. Other columns are not read.
    """
    groups = exact_groups(docs, id_col, text_col, normalise)
    rows = _hashes(docs, id_col, text_col, normalise).groupBy("h", "s", "id").agg(F.count(F.lit(1)).alias("n"))
    joined = rows.join(groups, ["h", "s"])
    first = (F.col("copy") == 1) & F.col("id").eqNullSafe(F.col("keep_id"))
    return joined.select("*", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy")).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        first.alias("kept"),
        F.lower(F.hex("s")).alias("text_sha256"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise: Normalise = one_space) -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with their columns; of repeated rows one stays.

    Ids may be of any type that can be ordered; a null id is a value of its own, the
    last one. Null texts count as empty. An empty table gives no rows. Columns of the
    input may have any names.
    """
    groups = exact_groups(docs, id_col, text_col, normalise)
    h, s, k = free_names(docs, "h", "s", "k")
    # An id inside a struct is never null itself, so plain equality serves, and one shuffle both steps.
    groups = groups.select(F.col("h").alias(h), F.col("s").alias(s), F.struct(F.col("keep_id").alias("id")).alias(k))
    text = normalise(text_or_empty(text_col))
    keys = {h: F.unhex(F.md5(text)), s: F.unhex(F.sha2(text, 256)), k: F.struct(F.col(id_col).alias("id"))}
    # These keys are nearly unique, so no group is large but that of one row repeated.
    stay = docs.withColumns(keys).join(groups, list(keys), "left_semi")
    return stay.dropDuplicates(list(keys)).select(*docs.columns)
