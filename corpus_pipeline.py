"""The corpus pipeline: documents through the stages in ``STAGES``, each written as Parquet and read by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_names, table, written
from tidemark.llm.exact_dedup import keep_first
from tidemark.llm.mixing import mix_sources
from tidemark.llm.native_queries import MIX_ALPHA, MIX_SEED
from tidemark.llm.ngram_join import jaccard_components
from tidemark.llm.pieces import encode_pieces
from tidemark.llm.python_queries import piece_digests, vocabulary
from tidemark.llm.quality import ACCEPT, fit_quality, fold, quality_score

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts. Labels of held-out rows are not learned."""
    model = fit_quality(docs, table(spark, sf_dir, "labels"), lambda i: fold(i.cast("string"), 4) != 2)
    good = quality_score(model)(F.col("text")) >= ACCEPT
    return docs.where(good)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space aside) the row with the smallest id stays."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays; rows that share an id stay or go together."""
    groups = jaccard_components(docs)
    (mark,) = free_names(docs, "first")
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(first, F.col("doc_id").eqNullSafe(F.col(mark)), "left_semi")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents replicated towards tempered shares of their sources, in a global random order."""
    return mix_sources(docs, MIX_ALPHA, seed=MIX_SEED).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Subword ids and decoded text of each copy, as digests."""
    encoded = encode_pieces(docs, vocabulary("piece_bpe_32k.model"), keep=("doc_id", "lang", "source"), decoded=True)
    return piece_digests(encoded, "lang", "source")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("mixing sources", mix),
    ("piece encoding", encode),
]

# The classifier's trees and the merges of the tokenizer have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over the documents; all but the last are written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
