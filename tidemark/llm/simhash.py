"""SimHash near-dedup by a segment-popcount embedding.

A fingerprint of 64 bits maps to 32 counts: the bits set in each segment of two.
The Manhattan distance of two count vectors is at most the number of differing
bits, so fingerprints that link are near in that space too. The range join is a
grid over each half of the vector (16 counts, packed in one number): of two
fingerprints within 4 bits one half is within distance 2, and two such points share
a cell among their own one and those one step away. Every fingerprint enters the
cells around it, so each pair that can link meets in a cell, where the differing
bits are counted exactly.

Cells are small unless many different near copies crowd one. A crowded cell is cut
into blocks that meet pairwise, so no task holds more than two blocks, and a cell
gives the edges of a spanning forest, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import map_batches, text_or_empty, written
from .components import components

# Bytes of text hashed in one batch, and shingles of one text whose bits are counted at once.
SLICE = 1 << 20
CHUNK = 1 << 16
# A half of the bits, and the lower bit of each of its segments.
HALF = 0xFFFFFFFF
LOW_BITS = 0x55555555
SEGMENTS = 16


@dataclass(frozen=True)
class SimHashParams:
    """``words`` in a shingle; ``seed`` of its hash; ``distance``: bits that linked fingerprints may differ in, 5 at most,
    for which halves stay within distance 2; ``block``: fingerprints of a cell compared in one piece."""

    words: int = 4
    seed: int = 42
    distance: int = 4
    block: int = 2048

    def __post_init__(self) -> None:
        if not 0 <= self.distance <= 5:
            raise ValueError("distance must be 0 to 5")
        if self.words < 1 or self.block < 1:
            raise ValueError("words and block must be at least 1")


def _shingles(text: bytes, words: int) -> Iterator[bytes]:
    """Runs of words joined by one space; with fewer words all of them."""
    own = text.lower().split()  # of bytes: A-Z only, and ASCII white space
    if not own:
        return
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1)
    starts = np.append(0, ends[: max(len(own) - words, 0)]).tolist()
    for a, b in zip(starts, ends[min(words, len(own)) - 1 :].tolist(), strict=True):
        yield joined[a : b - 1]


def fingerprint(text: bytes, params: SimHashParams = SimHashParams()) -> int:
    """Each bit: whether over half of the shingles' hashes have it. Zero without words."""
    hashes = np.fromiter((xxh64_intdigest(s, params.seed) for s in _shingles(text, params.words)), np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, params: SimHashParams, id_col: str, text_col: str) -> DataFrame:
    """``id, fp`` of every row; ``fp`` holds the 64 bits as a signed number."""
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = np.array([fingerprint(t, params) for t in batch.column("text").cast(pa.binary()).to_pylist()], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    return map_batches(texts, step, f"id {dict(texts.dtypes)['id']}, fp long", "text", SLICE)


def embedding(fp: Column) -> list[Column]:
    """The counts of the segments in each half: a field of 0, 1 or 2 in place of its two bits."""
    halves = [F.shiftrightunsigned(fp, 32 * i).bitwiseAND(F.lit(HALF)) for i in (0, 1)]
    return [h - F.shiftright(h, 1).bitwiseAND(F.lit(LOW_BITS)) for h in halves]


def cells(fp: Column) -> Column:
    """The cells of both halves: the fingerprint's own, and those where one count is one more or one less."""
    out = []
    for half, own in enumerate(embedding(fp)):
        named = own + F.lit(half << 32)
        out.append(named)
        for i in range(SEGMENTS):
            step = F.lit(1 << (2 * i)).cast("long")
            count = F.shiftright(own, 2 * i).bitwiseAND(F.lit(3).cast("long"))
            out += [F.when(count < 2, named + step), F.when(count > 0, named - step)]
    return F.array_compact(F.array(*out))


def _forest(fps: np.ndarray, distance: int) -> list[tuple[int, np.ndarray]]:
    """Edges of a spanning forest of the links among the fingerprints: each with those first reached from it."""
    edges, left, reached = [], fps, []
    while len(left) or reached:
        if not reached:
            reached, left = [left[0]], left[1:]
            continue
        one = reached.pop()
        near = np.bitwise_count(left ^ one) <= distance
        if near.any():
            edges.append((one, left[near]))
            reached += list(left[near])
            left = left[~near]
    return edges


# Cells up to this size are compared together, by neighbours at each distance.
SMALL = 16


def cell_links(group: np.ndarray, fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of neighbouring rows that connect all that is linked there."""
    begin = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(begin, len(group)))
    small = np.repeat(sizes <= SMALL, sizes)
    a, b = [], []
    for step in range(1, min(int(sizes.max(initial=0)), SMALL)):
        meet = np.flatnonzero((group[step:] == group[:-step]) & small[step:])
        x, y = fps[meet], fps[meet + step]
        near = np.bitwise_count(x ^ y) <= distance
        a.append(x[near])
        b.append(y[near])
    for at, size in zip(begin[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist(), strict=True):
        for one, others in _forest(fps[at : at + size], distance):
            a.append(np.full(len(others), one, fps.dtype))
            b.append(others)
    none = [np.zeros(0, fps.dtype)]
    return np.concatenate(a or none), np.concatenate(b or none)


def links(distinct: DataFrame, params: SimHashParams) -> DataFrame:
    """``a, b``: links that connect all different fingerprints within the distance, each once."""
    entries = distinct.select("fp", F.explode(cells(F.col("fp"))).alias("cell"))
    crowded = entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > params.block)
    # Written, so that its size decides how it is joined. Blocks of a crowded cell meet pairwise; another cell is one block.
    met = entries.join(written(crowded, "crowded"), "cell", "left")
    met = met.withColumn("blocks", F.coalesce(F.ceil(F.col("n") / params.block), F.lit(1)).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.where((F.col("blocks") == 1) | (F.col("own") != F.col("other")))
    unit = met.select("fp", "cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    dealt = unit.repartition("cell", "low", "high").sortWithinPartitions("cell", "low", "high", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 4), np.int64)

        def found(rows: np.ndarray) -> pa.RecordBatch:
            new = np.append(True, (rows[1:, 1:] != rows[:-1, 1:]).any(axis=1)) if len(rows) else np.zeros(0, bool)
            x, y = cell_links(np.cumsum(new), rows[:, 0].view(np.uint64), params.distance)
            x, y = x.view(np.int64), y.view(np.int64)
            pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], axis=1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("fp", "cell", "low", "high")], axis=1)
            rows = np.concatenate([held, rows])
            # The last unit may go on in the next batch.
            same = (rows[:, 1:] == rows[-1, 1:]).all(axis=1) if len(rows) else np.zeros(0, bool)
            held = rows[same]
            yield found(np.ascontiguousarray(rows[~same]))
        yield found(held)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def simhash_components(
    docs: DataFrame, params: SimHashParams = SimHashParams(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row.

    Null texts count as empty; texts without words have fingerprint zero, which links
    like any other. Equal fingerprints link, rows that repeat among them. A
    component's number is the smallest id in it; null ids count only where there is no
    other. Texts of any length are hashed whole, the bits counted in parts. An empty
    table gives no rows. Other columns are not read.
    """
    rows = written(fingerprints(docs, params, id_col, text_col), "fingerprints")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    labels = components(written(links(distinct.select("fp"), params), "links"))
    placed = distinct.join(labels, F.col("fp") == F.col("node"), "left").withColumn("component", F.coalesce("component", "fp"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.select("fp", "component").join(smallest, "component").select("fp", "component_id")
    out = rows.join(named, "fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return out.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.coalesce("component_id", "id").alias("component_id"))
