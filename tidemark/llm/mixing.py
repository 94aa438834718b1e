"""Mixing sources to target weights: Poisson replication.

A document of source ``s`` is repeated Poisson(rate_s) times, with
``rate_s = weight_s * budget / size_s``. The count inverts the Poisson
distribution at a number that the id's hash seeds, so it needs no state, repeats
on retry, and does not depend on the partitioning. DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names

# Rates above this are drawn as a sum of equal parts: exp(-rate) stays far from underflow.
PART = 16.0
# Terms of one part's distribution; beyond them less than 2^-52 is left of Poisson(16).
TERMS = 80
# Sources whose rates are sent to every executor; beyond that they are joined by a shuffle.
BROADCAST_SOURCES = 10_000
# Hex digits of the hash that make a uniform number: 52 bits, exact in a double.
DIGITS = 13


def source_rates(
    docs: DataFrame, weights: Mapping[str | None, float] | float, budget: float | None, source_col: str, size: Column
) -> DataFrame:
    """``source, rate``: weights as given by source (absent ones get none), or tempered by an exponent."""
    sizes = docs.groupBy(F.col(source_col).alias("source")).agg(F.coalesce(F.sum(size), F.lit(0)).cast("double").alias("size"))
    if isinstance(weights, Mapping):
        whole = sum(weights.values())
        if whole <= 0 or min(weights.values()) < 0:
            raise ValueError("weights must not be negative, and one must be positive")
        given = F.lit(0.0)
        for name, weight in weights.items():
            given = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(weight / whole)).otherwise(given)
        rated = sizes.withColumn("weight", given)
    else:
        part = F.when(F.col("size") > 0, F.pow("size", F.lit(float(weights)))).otherwise(0.0)
        powers = sizes.withColumn("part", part)
        rated = powers.withColumn("weight", F.col("part") / powers.agg(F.sum("part").alias("whole")).scalar())
    rows = rated.withColumn("budget", sizes.agg(F.sum("size").alias("total")).scalar() if budget is None else F.lit(float(budget)))
    return rows.select("source", F.when(F.col("size") > 0, F.col("weight") * F.col("budget") / F.col("size")).otherwise(0.0).alias("rate"))


def _cdf(rate: Column) -> Column:
    """P(X <= k) for k = 0, 1, ...: the running sum of exp(-rate) * rate^k / k!."""
    start = F.struct(F.array(F.exp(-rate)).alias("sums"), F.exp(-rate).alias("term"), F.exp(-rate).alias("sum"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * rate / k
        return F.struct(F.concat(acc["sums"], F.array(acc["sum"] + term)).alias("sums"), term.alias("term"), (acc["sum"] + term).alias("sum"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda acc: acc["sums"])


def _uniform(seed: Column, part: Column) -> Column:
    digits = F.substring(F.md5(F.concat_ws(":", seed, part.cast("string"))), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DIGITS))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | float,
    *,
    budget: float | None = None,
    seed: int = 0,
    measure: str = "rows",
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """The documents, each as often as its source's rate and its id's hash say, in a global random order.

    ``weights``: by source, or an exponent that tempers the sources' shares.
    ``budget``: the expected size of the result, in ``measure`` (``rows`` or
    ``chars``); the size of the input by default. Added columns: ``mix_copies``
    (long), ``mix_copy`` (from 1) and ``mix_key`` (hex), the order inside each
    partition; rows are dealt to partitions by it too. Input columns of these
    names are replaced.

    A null source is a source of its own. A null id is hashed as the word null.
    Rows that repeat an id get the same count. A source of size 0 (``chars`` over
    empty texts only) gets rate 0, as does one without weight. Empty in, empty out.
    """
    if measure not in ("rows", "chars"):
        raise ValueError("measure is rows or chars")
    size = F.lit(1) if measure == "rows" else F.coalesce(F.char_length(text_col), F.lit(0)).cast("long")
    rates = source_rates(docs, weights, budget, source_col, size)
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART)).cast("int")
    rates = rates.withColumn("parts", parts).withColumn("cdf", _cdf(F.col("rate") / F.col("parts")))
    own = docs.select(*[c for c in docs.columns if c not in ("mix_copies", "mix_copy", "mix_key")])
    source, parts, cdf = free_names(own, "source", "parts", "cdf")
    rates = rates.select(F.col("source").alias(source), F.col("parts").alias(parts), F.col("cdf").alias(cdf))
    # The number of sources is checked before their rates go to every executor.
    if docs.select(source_col).distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    rated = own.join(rates, F.col(source_col).eqNullSafe(F.col(source)))
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null")))

    def drawn(part: Column) -> Column:
        # An array of one, so that the number is hashed once and not for each term.
        return F.transform(F.array(_uniform(name, part)), lambda u: F.size(F.filter(F.col(cdf), lambda p: p <= u)))[0]

    draws = F.transform(F.sequence(F.lit(1), F.col(parts)), drawn)
    counted = rated.withColumn("mix_copies", F.aggregate(draws, F.lit(0), lambda a, b: a + b).cast("long"))
    copies = counted.where("mix_copies > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))))
    keyed = copies.withColumn("mix_key", F.md5(F.concat_ws(":", F.lit("order"), name, F.col("mix_copy").cast("string"))))
    return keyed.drop(source, parts, cdf).repartition("mix_key").sortWithinPartitions("mix_key")
