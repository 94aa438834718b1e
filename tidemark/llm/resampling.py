"""Importance resampling towards a target's distribution of hashed n-grams.

1. Each task counts its features into one array of ``buckets`` numbers; the arrays
   are summed, and the log ratio of target to corpus in each bucket is its gain.
2. A document's weight is the mean gain of its features; with noise drawn from a
   hash of its id the highest scores are a sample without replacement.
3. The last score that is drawn is found by a distributed quickselect: random
   pivot keys, exact counts of what lies below, at and above each, and the interval
   that holds the wanted rank goes on. No sort of all rows.
4. Only the winners are sorted (range partitioned) and ranked, by counts per part.

Keys are composite (score, then id), and rows that agree in all columns are folded
to one with a count before anything is compared, so repeats are one row wherever
they go.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import pieces, written

# A-Z become a-z; what is neither a letter, a digit nor beyond ASCII parts words.
_FOLD = bytes(i if i > 127 else ord(chr(i).lower()) if chr(i).isalnum() else 32 for i in range(256))
# Bytes of text that a task looks at together.
SLICE = 1 << 20
HASHED = 1 << 32


@dataclass(frozen=True)
class ResampleParams:
    """``longest`` run of words that is a feature; ``buckets`` of features; ``least_words`` of a document that may be drawn;
    ``percent`` of those that are; ``salt`` of the noise; ``pivots`` of a round, which changes no result."""

    longest: int = 2
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 25
    salt: str = "7"
    pivots: int = 31

    def __post_init__(self) -> None:
        if self.longest < 1 or self.buckets < 1 or self.pivots < 1:
            raise ValueError("longest, buckets and pivots must be at least 1")
        if not 0 <= self.percent <= 100:
            raise ValueError("percent must be 0 to 100")


def feature_buckets(text: bytes, params: ResampleParams) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every feature; a longer run's checksum goes on from the shorter one's."""
    words = text.translate(_FOLD).split()
    sums = list(map(crc32, words))
    out = list(sums)
    spaced = [b" " + w for w in words]
    for size in range(1, params.longest):
        sums = list(map(crc32, spaced[size:], sums))
        out += sums
    return len(words), np.array(out, np.int64) % params.buckets


def bucket_counts(texts: DataFrame, params: ResampleParams) -> np.ndarray:
    """Features of all texts by bucket: a row for each bucket and task meets in the sum, ``buckets`` numbers reach the driver."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(params.buckets, np.int64)
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                for text in part.column("text").drop_null().cast(pa.binary()).to_pylist():
                    counts += np.bincount(feature_buckets(text, params)[1], minlength=params.buckets)
        have = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(counts[have])], ["bucket", "n"])

    totals = texts.mapInArrow(step, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(params.buckets, np.int64)
    for row in totals.collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: the floored thousandfold log of the ratio of smoothed shares."""
    all_corpus, all_target = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * all_corpus / ((s + 1) * all_target))) for s, t in pairs], np.int64)


def noise(h: int) -> int:
    """A draw from the Gumbel distribution, in thousandths, of a number below 2^32."""
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / HASHED)))


ROW = ("id", "n_features", "n_words", "weight", "score")


def scored(docs: DataFrame, gains: np.ndarray, params: ResampleParams, id_col: str, text_col: str) -> DataFrame:
    """``id, n_features, n_words, weight, score`` and ``copies``, how many rows agree in these."""
    name = F.concat(F.lit(f"{params.salt}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col(id_col).alias("id"), h.alias("h"), F.col(text_col).alias("text"))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                numbers = []
                texts = part.column("text").cast(pa.binary()).to_pylist()
                for text, own in zip(texts, part.column("h").to_pylist(), strict=True):
                    words, found = feature_buckets(text or b"", params)
                    weight = int(gains[found].sum()) // len(found) if len(found) else 0
                    numbers.append((len(found), words, weight, weight + noise(own)))
                columns = np.array(numbers, np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(columns[:, i]) for i in range(4)]], list(ROW))

    kind = dict(rows.dtypes)["id"]
    return rows.mapInArrow(step, f"id {kind}, n_features long, n_words long, weight long, score long").groupBy(*ROW).agg(
        F.count(F.lit(1)).alias("copies")
    )


@dataclass(frozen=True)
class Place:
    """The key that holds a wanted rank, and how many rows come before it."""

    key: Row
    before: int


def _key() -> Column:
    """What is drawn first: higher scores, then smaller ids, null ids last; the rest parts rows that share an id."""
    return F.struct((-F.col("score")).alias("score"), F.col("id").isNull().alias("none"), "id", "n_features", "n_words")


def quickselect(rows: DataFrame, key: str, copies: str, rank: int, pivots: int, seed: int = 0) -> Place | None:
    """The ``rank``-th smallest key (from 1) of rows that stand for ``copies`` each; None if there are fewer.

    A round draws random keys of the open interval (those with the smallest hashes),
    counts exactly what lies below and at each, and keeps the interval between two of
    them that holds the rank. ``pivots`` keys and counts reach the driver.
    """
    kind = rows.schema[key].dataType
    left, before, turn = rows.select(key, copies), 0, seed
    while True:
        drawn = left.select(key).orderBy(F.xxhash64(key, F.lit(turn)), key).limit(pivots)
        keys = [r[key] for r in drawn.orderBy(key).collect()]
        if not keys:
            return None
        given = [F.lit(k).cast(kind) if not isinstance(k, Row) else _literal(k, kind) for k in keys]
        counts = [F.sum(F.when(test, F.col(copies))) for k in given for test in (F.col(key) < k, F.col(key) == k)]
        found = left.agg(*[F.coalesce(c, F.lit(0)).alias(f"c{i}") for i, c in enumerate(counts)]).first()
        low, high, passed = None, None, 0
        for i, k in enumerate(keys):
            below, at = found[2 * i], found[2 * i + 1]
            if rank <= before + below:
                high = given[i]
                break
            if rank <= before + below + at:
                return Place(k, before + below)
            low, passed = given[i], below + at
        if low is not None:
            left = left.where(F.col(key) > low)
        if high is not None:
            left = left.where(F.col(key) < high)
        before, turn = before + passed, turn + 1


def _literal(row: Row, kind) -> Column:
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in kind.fields])


def ranked(winners: DataFrame, key: str, copies: str, out: str) -> DataFrame:
    """The rows in order of ``key``, with the number of rows up to and including the first of their own copies as ``out``."""
    inner = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    names = winners.columns
    # Written as sorted, so that a row's part and place in it are facts.
    placed = winners.orderBy(key).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"))
    placed = written(placed, "sorted")
    # A row for each part.
    parts = placed.groupBy("part").agg(F.sum(copies).alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begin = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("begin"))
    own = placed.withColumn("inner", F.coalesce(F.sum(copies).over(inner), F.lit(0)))
    return own.join(F.broadcast(begin), "part").select(*names, (F.col("begin") + F.col("inner") + 1).alias(out))


def resample(
    docs: DataFrame, target: DataFrame, params: ResampleParams = ResampleParams(), id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row; ``rank`` is null for those that are not drawn.

    Null and empty texts have no features and weight 0. Null ids take the noise of
    ``null`` and lose ties. Ties on score go to the smaller id; rows that share an id
    and a score to fewer features, then fewer words; rows that repeat are drawn as
    often as there is room. An empty target gives every bucket the same share of it.
    Texts of any length are counted whole. An empty table gives no rows. Other columns
    are not read.
    """
    gains = bucket_gains(bucket_counts(docs.select(F.col(text_col).alias("text")), params), bucket_counts(target.select(F.col(target_text_col).alias("text")), params))
    rows = written(scored(docs, gains, params, id_col, text_col), "scored").withColumn("key", _key())
    allowed = F.col("n_words") >= params.least_words
    may = rows.where(allowed)
    total = may.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n")).first()["n"]
    wanted = params.percent * total // 100
    last = quickselect(may, "key", "copies", wanted, params.pivots) if wanted else None
    if last is None:
        out = rows.withColumn("rank", F.lit(None).cast("long"))
    else:
        won = allowed & (F.col("key") <= _literal(last.key, rows.schema["key"].dataType))
        lost = rows.where(~won).withColumn("rank", F.lit(None).cast("long"))
        out = ranked(rows.where(won), "key", "copies", "rank").unionByName(lost)
    single = out.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rank = F.col("rank") + F.col("copy")
    return single.select(
        F.col("id").alias("doc_id"), "n_features", "weight", "score", F.when(rank <= wanted, rank).alias("rank")
    )
