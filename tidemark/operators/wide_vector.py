"""Offset vectors of many database partitions.

With tens or hundreds of partitions a running value per partition, as a column
each, costs more than the vectors themselves. Here the records of a bucket, which
are gathered and sorted anyway, go through one Arrow step that fills all slots of a
batch at once; so do the folded totals that are carried from bucket to bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

# Slots of one output batch, which bounds its memory.
BATCH_SLOTS = 1 << 19


class _Fill:
    """The last text of each slot within the current group, over batches that come in order."""

    def __init__(self, n: int, start: list[str | None]):
        self.n, self.start, self.group = n, start, None
        self.state: list[str | None] = list(start)

    def enter(self, group: int, carry: list[str | None]) -> None:
        """Begins a group whose slots are known from before."""
        self.group = group
        self.state = [s if c is None else c for c, s in zip(carry, self.start, strict=True)]

    def vectors(self, group: np.ndarray, slot: np.ndarray, text: pa.Array) -> pa.Array:
        """Each row's vector, its own text included. A group that was not entered starts from the start vector."""
        rows, n = len(group), self.n
        # Places: the state on entry, the start vector, then the rows' own texts.
        pool = pa.concat_arrays([pa.array(self.state, pa.string()), pa.array(self.start, pa.string()), text])
        known = (slot >= 0) & (slot < n) & np.asarray(text.is_valid())
        filled = np.full((rows, n), -1, np.int64)
        own = np.flatnonzero(known)
        filled[own, slot[own]] = 2 * n + own
        edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist()
        for at, end in zip(edges, [*edges[1:], rows], strict=True):
            part = filled[at:end]
            base = np.arange(n) + (0 if at == 0 and group[0] == self.group else n)
            part[0] = np.maximum(part[0], base)
            np.maximum.accumulate(part, axis=0, out=part)
        self.group, self.state = group[-1], pool.take(pa.array(filled[-1])).to_pylist()
        offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * n)
        return pa.ListArray.from_arrays(offsets, pool.take(pa.array(filled.ravel())))


def _opened(rows: DataFrame, carried: DataFrame | None, group: str, order: str) -> DataFrame:
    """Rows and the carried vectors of their groups, together: dealt by group, the carried one first."""
    rows = rows.withColumn("__carry", F.lit(None).cast("array<string>"))
    if carried is not None:
        rows = rows.unionByName(carried, allowMissingColumns=True)
    return rows.repartition(group).sortWithinPartitions(group, F.col("__carry").isNull(), order)


def _carried(last: DataFrame, above: DataFrame | None, group: str, key: str, partition: str, n: int) -> DataFrame:
    """``key, __carry``: each slot's last text before the key, within its group; ``above`` is what the groups open with."""
    entries = last.groupBy(group, key).agg(F.collect_list(F.struct(F.col(partition).alias("slot"), "__last")).alias("entries"))
    dealt = _opened(entries, above, group, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, [None] * n
        for batch in batches:
            keys, vectors = [], []
            for own, at, new, carry in zip(*(batch.column(c).to_pylist() for c in (group, key, "entries", "__carry")), strict=True):
                if carry is not None or own != current:
                    current, state = own, list(carry or [None] * n)
                if carry is None:
                    keys.append(at)
                    vectors.append(list(state))
                    for entry in new:
                        state[entry["slot"]] = entry["__last"]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(vectors, pa.list_(pa.string()))], [key, "__carry"])

    return dealt.select(group, key, "entries", "__carry").mapInArrow(run, f"{key} long, __carry array<string>")


def wide_vectors(
    df: DataFrame, text: str, n: int, start: list[str | None], out: str, bucket: str, fanout: int, levels: int, seq: str, partition: str
) -> DataFrame:
    """``df`` (with its ``bucket``, and the offset as ``text``) and the vector after each record."""
    carried = None
    if levels:
        slots = df.select(bucket, seq, partition, text).where(F.col(partition).between(0, n - 1) & F.col(text).isNotNull())
        last = slots.groupBy(bucket, partition).agg(F.max_by(text, seq).alias("__last"))
        size = F.lit(fanout).cast("bigint")
        block = F.call_function("div", F.col(bucket) - F.pmod(F.col(bucket), size), size)
        last = last.withColumn("__group", block if levels > 1 else F.lit(0).cast("bigint"))
        above = None
        if levels > 1:
            # A row per block, the blocks in one list.
            totals = last.groupBy("__group", partition).agg(F.max_by("__last", bucket).alias("__last"))
            above = _carried(totals.withColumn("__top", F.lit(0).cast("bigint")), None, "__top", "__group", partition, n)
        carried = _carried(last, above, "__group", bucket, partition, n)
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(StringType()))])
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fill = _Fill(n, start)
        step = max(1, BATCH_SLOTS // n)
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                opens = np.flatnonzero(np.asarray(batch.column("__carry").is_valid())).tolist()
                for begin, end in zip([0, *[o + 1 for o in opens]], [*opens, batch.num_rows], strict=True):
                    part = batch.slice(begin, end - begin)
                    if part.num_rows:
                        slot = part.column(partition).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                        vectors = fill.vectors(part.column(bucket).to_numpy(zero_copy_only=False), slot, part.column(text))
                        yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], vectors], [*names, out])
                    if end < batch.num_rows:
                        fill.enter(batch.column(bucket)[end].as_py(), batch.column("__carry")[end].as_py())

    return _opened(df, carried, bucket, seq).mapInArrow(run, schema)
