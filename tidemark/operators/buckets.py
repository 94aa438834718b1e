"""Equal-depth buckets of an order column, and exact ranks over them.

An ordered window over a whole log would be one task. Buckets of about the same
number of records are what its steps work on instead: bounds come from quantiles of
the order column (a pass over that column alone, before the frame's own run), whatever
the numbers look like. A bucket is named by one number, ``coarse * FANOUT + fine``: at
most ``COARSE`` equal-depth parts, each cut into at most ``FANOUT`` parts of equal
width. So no step orders more than ``COARSE`` or ``FANOUT`` totals, and equal
numbers share a bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..logschema import SEQ

COARSE = 1 << 10
FANOUT = 1 << 10
# Error of a quantile, as a share of all records: well under the depth of a coarse part.
ACCURACY = 10 * COARSE


def whole_div(c: Column, n: int) -> Column:
    """Whole buckets of a number, also below zero."""
    size = F.lit(n).cast("bigint")
    return F.call_function("div", c - F.pmod(c, size), size)


@dataclass(frozen=True)
class Depths:
    """Where each coarse part but the first begins, the smallest and largest number, and the fine parts in a coarse one."""

    bounds: list[int]
    low: int
    high: int
    fine: int

    @property
    def single(self) -> bool:
        return not self.bounds and self.fine == 1


def depth_bounds(df: DataFrame, depth: int, order: str = SEQ, coarse: int = COARSE, fanout: int = FANOUT) -> Depths:
    """Bounds of buckets of about ``depth`` rows. At most ``coarse`` quantiles reach the driver, from a pass over one column."""
    shares = ", ".join(repr(i / coarse) for i in range(coarse))
    number = f"CAST(`{order}` AS BIGINT)"
    row = df.select(order).agg(
        F.expr(f"percentile_approx({number}, array({shares}), {ACCURACY})").alias("q"),
        F.count(order).alias("n"),
        F.min(F.col(order).cast("bigint")).alias("low"),
        F.max(F.col(order).cast("bigint")).alias("high"),
    ).first()
    if not row["n"]:
        return Depths([], 0, 0, 1)
    parts = min(-(-row["n"] // depth), coarse)
    fine = min(-(-row["n"] // (parts * depth)), fanout)
    bounds = sorted({row["q"][i * coarse // parts] for i in range(1, parts)})
    return Depths(bounds, row["low"], row["high"], fine)


def depth_bucket(order: Column, depths: Depths, fanout: int = FANOUT) -> Column:
    """The bucket of a number; it never falls as the number rises."""
    value = order.cast("bigint")
    bounds = F.expr("array({})".format(", ".join(f"{b}L" for b in depths.bounds)) if depths.bounds else "CAST(array() AS array<bigint>)")
    # A binary search, as a fold over halving steps: how many bounds are at or below the number.
    steps = [1 << k for k in reversed(range(len(depths.bounds).bit_length()))]
    part = F.lit(0)
    if steps:
        halving = F.expr(f"array({', '.join(map(str, steps))})")
        part = F.aggregate(halving, F.lit(0), lambda at, s: at + F.when(F.get(bounds, at + s - 1) <= value, s).otherwise(0))

    def place(at: Column) -> Column:
        begin = F.coalesce(F.get(bounds, at - 1), F.lit(depths.low)).cast("double")
        end = F.coalesce(F.get(bounds, at), F.lit(depths.high)).cast("double")
        share = (value.cast("double") - begin) / F.greatest(end - begin, F.lit(1.0))
        fine = F.least(F.floor(share * depths.fine), F.lit(depths.fine - 1))
        return at.cast("bigint") * fanout + F.greatest(fine, F.lit(0))

    if depths.fine == 1:
        return part.cast("bigint") * fanout
    # An array of one, so that the search is done once.
    return F.transform(F.array(part), place)[0]


def with_rank(df: DataFrame, depth: int, out: str = "rank", order: str = SEQ, coarse: int = COARSE, fanout: int = FANOUT) -> DataFrame:
    """Adds the exact place of each row in the order of a unique number, from 1, without ordering all rows in one task.

    Totals of buckets are summed inside their coarse part, and those of coarse parts in
    one list of at most ``coarse`` rows.
    """
    names = df.columns
    depths = depth_bounds(df, depth, order, coarse, fanout)
    if depths.single:
        return df.withColumn(out, F.row_number().over(Window.orderBy(order)).cast("bigint"))
    placed = df.withColumn("__bucket", depth_bucket(F.col(order), depths, fanout))
    sizes = placed.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n")).withColumn("__part", whole_div(F.col("__bucket"), fanout))

    def earlier(window: WindowSpec) -> Column:
        return F.coalesce(F.sum("__n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    inner = earlier(Window.partitionBy("__part").orderBy("__bucket"))
    parts = sizes.groupBy("__part").agg(F.sum("__n").alias("__n"))
    outer = earlier(Window.orderBy("__part"))
    begin = sizes.select("__bucket", "__part", inner.alias("__inner")).join(parts.select("__part", outer.alias("__outer")), "__part")
    own = F.row_number().over(Window.partitionBy("__bucket").orderBy(order))
    ranked = placed.withColumn("__own", own).join(begin.select("__bucket", (F.col("__inner") + F.col("__outer")).alias("__begin")), "__bucket")
    return ranked.select(*names, (F.col("__begin") + F.col("__own")).alias(out))
