"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing column names."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use for columns of their own.
CLASH = (
    "h t s id name n at key row content start end ids score predicted mix_copy __text kept spans fp cell rank weight copies x v cluster "
    "__h __s __k __z __source __parts __cdf __id __label __first label"
).split()


def texts(seed: int = 5) -> list[str | None]:
    rng = random.Random(seed)
    word = ["alpha", "Beta", "gamma,", "delta.", "épsilon", "日本", "x", "token=abcdef12"]
    base = [" ".join(rng.choices(word, k=60)) for _ in range(3)]
    near = [base[0] + " tail", base[0].replace("alpha", "omega", 1), base[1] + "\n" + base[2]]
    return [
        None, "", " \t\n", "one", "two  words", "two words", "a b c", *base, *near, base[0], base[0], "\n".join([base[1]] * 4),
        " ".join(rng.choices(word, k=30_000)), "ab" * 2000, "\0 nul", "é" * 500, "And " * 400,
    ]


def edge_frame(spark: SparkSession, ids: bool = True) -> DataFrame:
    """All edge texts, with a null id, a repeated row, and a repeated id on another text."""
    rows = [(i, t, "en", "a" if i % 3 else None, len(t or "")) for i, t in enumerate(texts())]
    if ids:
        rows += [rows[9], (None, rows[8][1], None, None, None), (None, "lone null", "en", "b", 9), (3, "another text", "en", "b", 12)]
    return spark.createDataFrame(rows, SCHEMA)


def with_clashes(docs: DataFrame) -> DataFrame:
    """The same rows with columns named like the operators' own."""
    return docs.selectExpr("*", *[f"'clash' as `{c}`" for c in CLASH])


def empty_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))
