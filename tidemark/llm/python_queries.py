"""Queries of the operators that work in Arrow batches: 2, 3, 4, 6 to 9, and 11 to 13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .centroids import cluster_vectors
from .common import table
from .ngram_join import jaccard_components
from .pieces import encode_pieces
from .quality import classify, fit_quality, fold
from .registry import query
from .repetition import repetition
from .resampling import resample
from .simhash import simhash_components
from .sql_twins import CLUSTER_SQL, RESAMPLE_SQL
from .substring_dedup import substring_dedup
from .token_counts import token_counts
from .toxicity import fit_lexicon, toxicity


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file on this installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _digits(ids: str):
    return F.array_join(F.col(ids).cast("array<string>"), ",")


def piece_digests(encoded: DataFrame, *more: str) -> DataFrame:
    covered = F.coalesce(F.get("ends", F.size("ends") - 1), F.lit(0))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(_digits("ids"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        covered.cast("long").alias("span_bytes"),
        *more,
    )


@query("op9_piece_encode")
def op9_piece_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole document, as digests; ``span_bytes`` is how far the source spans reach."""
    docs = table(spark, sf_dir, "documents")
    return piece_digests(encode_pieces(docs, vocabulary("piece_bpe_32k.model"), decoded=True))


@query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by trees that saw no label of a held-out row."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), lambda i: fold(i.cast("string"), 4) != 2)
    held_out = (fold("doc_id", 4) == 2).alias("held_out")
    return classify(docs.select("doc_id", "text"), model).select("doc_id", held_out, "score", "predicted")


@query("op3_repetition")
def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every whole document and the verdict on its repeats."""
    return repetition(table(spark, sf_dir, "documents"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a lexicon that saw no label of a held-out row."""
    docs = table(spark, sf_dir, "documents")
    lexicon = fit_lexicon(docs, table(spark, sf_dir, "labels"), lambda i: fold(i.cast("string"), 5) != 0)
    held_out = (fold("doc_id", 5) == 0).alias("held_out")
    return toxicity(docs.select("doc_id", "text"), lexicon).select("doc_id", held_out, "score", "predicted")


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every whole document."""
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op6_ngram_join")
def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under links of 4-word shingles at a similarity of 0.85."""
    return jaccard_components(table(spark, sf_dir, "documents"))


@query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without the bytes of repeated 400-byte strings."""
    out = substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_simhash")
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their components under links of 4 bits or fewer."""
    return simhash_components(table(spark, sf_dir, "documents"))


@query("op12_centroids", CLUSTER_SQL)
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 finite components in 40 clusters, after five rounds."""
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


@query("op13_resample", RESAMPLE_SQL)
def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, a quarter of the long ones drawn and ranked by how much they are like the benchmark."""
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
