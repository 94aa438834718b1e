"""Arrival order across batches: how far a log is complete, which numbers are missing, where batches are cut.

Files of a log can reach a stream out of order. Where arrival numbers have no holes,
the numbers alone say how far the log is complete: what lies beyond the first
missing one waits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..logschema import SEQ
from .buckets import with_rank

# Numbers of one bitmap of Spark's bitmap functions (a fixed value).
CHUNK = 32_768


class OutOfOrderError(RuntimeError):
    """A record came after later ones were emitted, or twice. Not worth a retry."""


def _places(rows: DataFrame, frontier: int, seq: str) -> DataFrame:
    """Numbers after the frontier, counted from 1, and the chunk each lies in."""
    place = F.col(seq) - F.lit(frontier).cast("bigint")
    return rows.where(F.col(seq) > frontier).select(F.col(seq).alias("seq"), place.alias("place"), F.bitmap_bucket_number(place).alias("chunk"))


def complete_upto(rows: DataFrame, frontier: int, *, seq: str = SEQ) -> DataFrame:
    """One row ``upto, highest, rows, numbers``: the last number up to which none is missing after ``frontier``.

    ``rows`` and ``numbers`` differ where a number occurs twice. A chunk of numbers is
    one bitmap, folded before the shuffle; only chunks (one row per 32,768 numbers) and
    the numbers of the first chunk with a hole are ever ordered.
    """
    places = _places(rows, frontier, seq)
    bits = F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("place")))
    chunks = places.groupBy("chunk").agg(bits.alias("numbers"), F.count(F.lit(1)).alias("rows"), F.max("seq").alias("highest"))
    full = chunks.where(F.col("numbers") == CHUNK).select("chunk", F.row_number().over(Window.orderBy("chunk")).alias("nth"))
    whole = full.where("nth = chunk").agg(F.count(F.lit(1)).alias("n")).scalar()
    edge = places.where(F.col("chunk") == whole + 1).select("place").distinct()
    nth = F.row_number().over(Window.orderBy("place")) + whole * CHUNK
    inner = edge.select("place", nth.alias("nth")).where("nth = place").agg(F.count(F.lit(1)).alias("n")).scalar()
    totals = chunks.agg(F.sum("rows").alias("rows"), F.sum("numbers").alias("numbers"), F.max("highest").alias("highest"))
    start = F.lit(frontier).cast("bigint")
    none = F.lit(0).cast("bigint")
    return totals.select(
        (start + whole * CHUNK + inner).alias("upto"),
        F.coalesce("highest", start).alias("highest"),
        F.coalesce("rows", none).alias("rows"),
        F.coalesce("numbers", none).alias("numbers"),
    )


def arrival_gaps(rows: DataFrame, frontier: int, *, seq: str = SEQ) -> DataFrame:
    """``gap_begin, gap_end``: the runs of numbers missing between ``frontier`` and the highest one seen.

    Neighbours are compared inside chunks of numbers, and the chunks by their ends: one
    row per chunk that has any number.
    """
    places = _places(rows, frontier, seq)
    previous = F.lag("seq").over(Window.partitionBy("chunk").orderBy("seq"))
    inner = places.select("seq", previous.alias("previous")).where(F.col("previous").isNotNull())
    ends = places.groupBy("chunk").agg(F.min("seq").alias("seq"), F.max("seq").alias("last"))
    before = F.lag("last", 1, frontier).over(Window.orderBy("chunk"))
    both = inner.unionByName(ends.select("seq", before.alias("previous")))
    gap = both.where(F.col("seq") > F.col("previous") + 1)
    return gap.select((F.col("previous") + 1).alias("gap_begin"), (F.col("seq") - 1).alias("gap_end"))


def event_cuts(events: DataFrame, most: int, depth: int, *, seq: str = SEQ) -> DataFrame:
    """``part, last, rows``: the last ``seq`` of each run of at most ``most`` events, in order from 0."""
    size = F.lit(most).cast("bigint")
    part: Column = F.call_function("div", F.col("rank") - 1, size)
    ranks = with_rank(events.select(seq), depth, "rank", seq)
    return ranks.groupBy(part.alias("part")).agg(F.max(seq).alias("last"), F.count(F.lit(1)).alias("rows"))
