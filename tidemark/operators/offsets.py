"""Offset vectors: attaching them to events, and catalog aggregates over offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.offsets import to_hex
from ..logschema import SEQ
from .buckets import FANOUT, depth_bounds, depth_bucket, whole_div
from .wide_vector import wide_vectors

# Records of a bucket.
BUCKET_ROWS = 1 << 18
# Levels of totals above equal-depth buckets: coarse parts, and buckets in them.
LEVELS = 2
# Up to this many partitions each slot is a column with a running value; beyond, all slots are filled in one step.
NARROW_VECTOR = 16


def _slot(i: int) -> str:
    return f"__slot_{i}"


def _block(level: int) -> str:
    return f"__block_{level}"


def _start(start: list[str | None] | None, i: int) -> Column:
    value = start[i] if start is not None else None
    return F.lit(value).cast("string")


def _as_text(df: DataFrame, offset: str) -> Column:
    return to_hex(offset) if df.schema[offset].dataType.typeName() == "binary" else F.col(offset)


def carried_offsets(
    placed: DataFrame,
    n: int,
    *,
    fanout: int = FANOUT,
    levels: int = LEVELS,
    seq: str = SEQ,
    partition: str = "PartitionId",
    offset: str = "Offset",
) -> DataFrame:
    """Per bucket of records that have theirs, each slot's last offset *before* the bucket.

    Reads the three ordering columns only, and folds them before the shuffle:
    one row per bucket and database partition. Bucket totals roll up into
    blocks of ``fanout`` children, level over level; running values are then
    taken inside each block, so no window below the top spans more than
    ``fanout`` rows.
    """
    slots = range(n)
    last = (
        placed.select(_block(0), seq, partition, offset)
        .groupBy(_block(0), partition)
        .agg(F.max_by(offset, seq).alias("__last"))
    )
    placed = _gather(last, 0, levels, fanout)
    totals = [
        placed.groupBy(*_levels(0, levels)).agg(
            *[F.max(F.when(F.col(partition) == i, F.col("__last"))).alias(_slot(i)) for i in slots]
        )
    ]
    for level in range(1, levels):
        child = _block(level - 1)
        block = totals[-1].groupBy(_block(level)).agg(
            *[F.max_by(_slot(i), F.when(F.col(_slot(i)).isNotNull(), F.col(child))).alias(_slot(i)) for i in slots]
        )
        totals.append(_gather(block, level, levels, fanout))
    carried: DataFrame | None = None
    for level in reversed(range(levels)):
        own = _block(level)
        parents = _levels(level, levels)[:-1]
        ordered = Window.partitionBy(*parents).orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
        inside = totals[level].select(
            own, *parents, *[F.last(_slot(i), True).over(ordered).alias(_slot(i)) for i in slots]
        )
        if carried is None:
            carried = inside
            continue
        above = carried.select(*parents, *[F.col(_slot(i)).alias(f"__above_{i}") for i in slots])
        # A left join: an inner one would filter one of the two readers of the totals,
        # and they would no longer share one shuffle.
        carried = inside.join(above, parents, "left").select(
            own, *[F.coalesce(_slot(i), f"__above_{i}").alias(_slot(i)) for i in slots]
        )
    return carried


def _levels(level: int, levels: int) -> list[str]:
    """The keys that name a block: its parent, if it has one, and itself."""
    return [_block(level + 1), _block(level)] if level + 1 < levels else [_block(level)]


def _gather(df: DataFrame, level: int, levels: int, fanout: int) -> DataFrame:
    """Brings the children of a block together: one shuffle serves all that is done inside the block."""
    if level + 1 >= levels:
        return df
    return df.withColumn(_block(level + 1), whole_div(F.col(_block(level)), fanout)).repartition(_block(level + 1))


def with_offset_vector(
    df: DataFrame,
    n: int,
    start: list[str | None] | None = None,
    *,
    out: str = "offsets",
    records: int | None = None,
    span: tuple[int, int] | None = None,
    bucket_rows: int = BUCKET_ROWS,
    fanout: int = FANOUT,
    levels: int | None = None,
    seq: str = SEQ,
    partition: str = "PartitionId",
    offset: str = "Offset",
) -> DataFrame:
    """Adds the vector as it stands after each record's own offset was applied.

    One ordered window over the whole log would be one task. Instead the wide
    rows are shuffled once, by bucket of about ``bucket_rows`` records, and the
    running value is taken inside the bucket; what came before the bucket is
    joined on from :func:`carried_offsets`, on the same bucketing. ``seq`` must be
    unique.

    Buckets have equal depth (see :mod:`.buckets`), however far apart the numbers
    lie. ``records`` is how many there are, where a caller knows it (a
    micro-batch does): those of one bucket need no carried values at all. A caller
    who knows that numbers are dense can have buckets of ``bucket_rows`` *numbers*
    instead, with ``levels`` of blocks over them, or as many as the ``span`` (the
    smallest and largest number) needs.
    """
    if n < 1 or (levels is not None and levels < 1):
        raise ValueError("a vector needs at least one element and one level")
    if start is not None and len(start) != n:
        raise ValueError(f"start vector has {len(start)} elements, expected {n}")
    names = df.columns
    placed = df.withColumn(_block(0), whole_div(F.col(seq), bucket_rows))
    if records is not None and records <= bucket_rows:
        placed, levels = df.withColumn(_block(0), F.lit(0).cast("bigint")), 0
    elif span is not None:
        buckets = span[1] // bucket_rows - span[0] // bucket_rows + 1
        needed = 0 if buckets == 1 else 1
        while fanout**needed < buckets:
            needed += 1
        levels = min(levels or LEVELS, needed)
    elif levels is None:
        depths = depth_bounds(df, bucket_rows, seq, fanout=fanout)
        placed, levels = df.withColumn(_block(0), depth_bucket(F.col(seq), depths, fanout)), 0 if depths.single else LEVELS
    if n > NARROW_VECTOR:
        keyed = placed.withColumn("__text", _as_text(df, offset))
        filled = wide_vectors(keyed, "__text", n, start or [None] * n, out, _block(0), fanout, levels, seq, partition)
        return filled.select(*names, out)
    is_binary = df.schema[offset].dataType.typeName() == "binary"
    upto = Window.partitionBy(_block(0)).orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    # Shuffled explicitly: the window's own shuffle would also carry one input column per slot.
    # Bytes travel, and each becomes text once, where it enters a slot.
    dealt = placed.repartition(_block(0))
    text = to_hex(offset) if is_binary else F.col(offset)
    rows = dealt.select(
        *names,
        _block(0),
        *[F.last(F.when(F.col(partition) == i, text), True).over(upto).alias(f"__own_{i}") for i in range(n)],
    )
    known = [[F.col(f"__own_{i}")] for i in range(n)]
    if levels:
        before = carried_offsets(
            placed, n, fanout=fanout, levels=levels, seq=seq, partition=partition, offset=offset
        )
        if is_binary:
            before = before.select(_block(0), *[to_hex(_slot(i)).alias(_slot(i)) for i in range(n)])
        rows = rows.join(before, _block(0), "left")
        known = [[*own, F.col(_slot(i))] for i, own in enumerate(known)]
    slots = [F.coalesce(*own, _start(start, i)) for i, own in enumerate(known)]
    return rows.select(*names, F.array(*slots).alias(out))


def global_offset_vector(
    df: DataFrame,
    n: int,
    start: list[str | None] | None = None,
    *,
    out: str = "offsets",
    seq: str = SEQ,
    partition: str = "PartitionId",
    offset: str = "Offset",
) -> DataFrame:
    """The defining form of :func:`with_offset_vector`, as one window. For tests on small data only."""
    upto = Window.orderBy(seq).rowsBetween(Window.unboundedPreceding, 0)
    text = _as_text(df, offset)
    return df.select(
        "*",
        F.array(
            *[
                F.coalesce(F.last(F.when(F.col(partition) == i, text), True).over(upto), _start(start, i))
                for i in range(n)
            ]
        ).alias(out),
    )


def last_vector(
    df: DataFrame,
    n: int,
    *,
    out: str = "offsets",
    seq: str = SEQ,
    partition: str = "PartitionId",
    offset: str = "Offset",
) -> DataFrame:
    """One row: the last offset of each database partition as the array 0..n-1, null where there is none.

    A running value per slot, folded inside every input split; nothing is grouped or sorted.
    """
    last = [
        F.max_by(F.col(offset), F.when(F.col(partition) == i, F.col(seq))).alias(_slot(i)) for i in range(n)
    ]
    found = df.agg(*last)
    return found.select(F.array(*[_as_text(found, _slot(i)) for i in range(n)]).alias(out))


def dense_vector(df: DataFrame, n: int, *, out: str = "offsets") -> DataFrame:
    """``(ordinal, offset)`` rows as one row holding the array 0..n-1, null where missing."""
    return df.agg(
        F.array(*[F.max(F.when(F.col("ordinal") == i, F.col("offset"))) for i in range(n)]).alias(out)
    )


def _catalog(df: DataFrame, kind: str) -> DataFrame:
    return df.where(F.col("OFFSET_TYPE") == kind).select(
        F.col("ORDINAL").cast("int").alias("ordinal"), _as_text(df, "OFFSET").alias("offset")
    )


def oldest_snapshot_begin(offsets_df: DataFrame, n: int) -> DataFrame:
    """One row: per partition the smallest ``snapshot_begin`` offset."""
    oldest = _catalog(offsets_df, "snapshot_begin").groupBy("ordinal").agg(F.min(F.lower("offset")).alias("offset"))
    return dense_vector(oldest, n)


def log_tails(offsets_df: DataFrame, n: int) -> DataFrame:
    """One row: per partition the largest ``log_tail`` offset."""
    tails = _catalog(offsets_df, "log_tail").groupBy("ordinal").agg(F.max(F.lower("offset")).alias("offset"))
    return dense_vector(tails, n)


def vectors_stale(stored: Column, oldest: Column) -> Column:
    """True when, in some partition, the oldest offset still held lies after the stored one."""
    later = F.zip_with(stored, oldest, lambda s, o: F.coalesce(o > s, F.lit(False)))
    return F.coalesce(F.exists(later, lambda x: x), F.lit(False))


def is_stale(stored: DataFrame, oldest: DataFrame) -> DataFrame:
    """One row ``stale`` from two one-row frames with an ``offsets`` array each."""
    both = stored.select(F.col("offsets").alias("__stored"), oldest.select("offsets").scalar().alias("__oldest"))
    return both.select(vectors_stale(F.col("__stored"), F.col("__oldest")).alias("stale"))


def begin_at(
    df: DataFrame,
    offsets: list[str | None] | DataFrame,
    *,
    partition: str = "PartitionId",
    offset: str = "Offset",
) -> DataFrame:
    """Records strictly after the given offset of their own partition; null means from the beginning.

    Records whose partition is null, negative or beyond the vector are kept, whatever its width.

    A list becomes comparisons against literals, which parquet can use to skip
    row groups. A one-row frame with an ``offsets`` array, as :func:`last_vector`
    gives, is computed first and compared as one value of bounded size; the
    records are neither joined nor shuffled.
    """
    is_binary = df.schema[offset].dataType.typeName() == "binary"
    if isinstance(offsets, DataFrame):
        vector = offsets.select(F.transform("offsets", F.unhex) if is_binary else F.col("offsets")).scalar()
        own = F.get(vector, F.col(partition))
        return df.where(own.isNull() | (F.col(offset) > own))

    def literal(text: str) -> Column:
        # An odd digit is the low half of its byte, as in unhex.
        return F.lit(bytes.fromhex(text.zfill(len(text) + len(text) % 2)) if is_binary else text.lower())

    known = [(i, o) for i, o in enumerate(offsets) if o is not None]
    if not known:
        return df
    own = F.col(partition)
    # A partition without a start offset is read from its beginning; one that is unknown is kept for the strict checks.
    free = [i for i, o in enumerate(offsets) if o is None]
    kept = [own.isNull(), own < 0, own >= len(offsets), *([own.isin(free)] if free else [])]
    return df.where(_any(kept + [(own == i) & (F.col(offset) > literal(o)) for i, o in known]))


def _any(terms: list[Column]) -> Column:
    """One condition of many, as a balanced tree: a chain of hundreds of terms would nest as deep."""
    while len(terms) > 1:
        terms = [a | b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) - len(terms) % 2 :]
    return terms[0]
