"""Suffix-array dedup: bytes covered by a long string that starts anywhere else in the corpus.

1. Each text's windows fall into segments by content-defined anchors
   (``anchors``): equal windows carry the same anchor. Only anchors that occur
   twice go on; of a segment that repeats as a whole all windows are repeats.
2. Segments under one anchor that differ, and that agree in some place from the anchor,
   are indexed together, in blocks of a few MB: a run-length transform with sampled run ends, from which matching
   statistics stream (``run_index``).
3. An anchor with very many different segments (the edge of a passage that a large
   share of documents quote) is not gathered: its windows are hashed and counted,
   which folds before the shuffle. Blocks of neighbouring windows come first, as runs;
   single windows are looked at only where a block is not repeated as a whole. This
   finds the same windows.
4. Repeated windows return to their documents, which are cut.

The texts are shuffled twice, by document; everything else is narrow or repeated.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import GRAM, gram_hashes, segments
from .common import map_batches, text_or_empty, written
from .run_index import long_matches


@dataclass(frozen=True)
class SubstringParams:
    """``window``: bytes of a string that counts. ``block``: bytes of segments indexed together. ``gathered``: different
    segments of one anchor that may be; beyond, windows are counted by hash. Neither changes the result."""

    window: int = 400
    block: int = 1 << 20
    gathered: int = 500


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows by id and content: rows that repeat both share what is found, each as one more occurrence."""
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return rows.select("id", F.xxhash64("text").alias("content"), F.xxhash64("id").alias("row"), "text")


def _binary(batch: pa.RecordBatch) -> list[bytes]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def _segments(rows: DataFrame, params: SubstringParams) -> DataFrame:
    """``row, content, name, starts, counts``: every segment, those of one text and anchor in one row."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = segments(_binary(batch), params.window)
        order = np.lexsort((found.start, found.name, found.text))
        text, name = found.text[order], found.name[order]
        firsts = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (name[1:] != name[:-1]))[: len(order)])
        offsets = pa.array(np.append(firsts, len(order)), pa.int32())
        columns = [batch.column(c).take(pa.array(text[firsts])) for c in ("row", "content")] + [pa.array(name[firsts])]
        columns += [pa.ListArray.from_arrays(offsets, pa.array(values[order], pa.int32())) for values in (found.start, found.count)]
        yield pa.RecordBatch.from_arrays(columns, ["row", "content", "name", "starts", "counts"])

    schema = "row long, content long, name long, starts array<int>, counts array<int>"
    return map_batches(rows.select("row", "content", "text"), step, schema, "text", 1 << 20)


def _union(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Spans in order, those that overlap or touch joined."""
    union: list[list[int]] = []
    for begin, end in sorted(spans):
        if union and begin <= union[-1][1]:
            union[-1][1] = max(union[-1][1], end)
        else:
            union.append([begin, end])
    return union


SPAN_FIELDS = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
SPAN_TYPE = "array<struct<begin:int,end:int>>"


def _span_list(spans: list[list[int]]) -> list[dict[str, int]]:
    return [{"begin": a, "end": b} for a, b in spans]


CUTS = f"row long, content long, name long, s1 long, s2 long, times int, spans {SPAN_TYPE}, bytes binary"


def _cut(rows: DataFrame, chosen: DataFrame, params: SubstringParams) -> DataFrame:
    """The chosen segments with a 128-bit hash of their bytes, and the bytes where a batch has them first.

    A segment that a text has several times (a line said again and again) is one row: how often, and the bytes it covers.
    """
    runs = chosen.groupBy("row", "content").agg(F.collect_set(F.struct("name", "starts", "counts")).alias("runs"))
    joined = rows.select("row", "content", "text").join(runs, ["row", "content"])

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        out: list[tuple] = []
        texts = _binary(batch)
        for row, content, text, own in zip(*(batch.column(c).to_pylist() for c in ("row", "content")), texts, batch.column("runs").to_pylist(), strict=True):
            places: dict[tuple[int, bytes], list[tuple[int, int]]] = {}
            for run in own:
                for start, count in zip(run["starts"], run["counts"], strict=True):
                    end = start + count + params.window - 1
                    digest = hashlib.blake2b(text[start:end], digest_size=16).digest()
                    places.setdefault((run["name"], digest), []).append((start, end))
            for (name, digest), spans in places.items():
                s1, s2 = np.frombuffer(digest, np.int64).tolist()
                piece = None if digest in seen else text[slice(*spans[0])]
                out.append((row, content, name, s1, s2, len(spans), _span_list(_union(spans)), piece))
                seen.add(digest)
        columns = zip(*out, strict=True) if out else [()] * 8
        kinds = [*[pa.int64()] * 5, pa.int32(), pa.list_(SPAN_FIELDS), pa.binary()]
        names = ["row", "content", "name", "s1", "s2", "times", "spans", "bytes"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return map_batches(joined, step, CUTS, "text", 4 << 20)


# Places before the anchor from which windows may begin that are compared together before segments are indexed.
STEP = 42


def _sharing(names: list[int], strings: list[bytes], window: int) -> list[int]:
    """Which segments may share a window with another one of their anchor, in order.

    Equal windows begin equally far before the anchor. Those that begin within
    ``STEP`` places have the bytes from the last beginning to the first end in common,
    so segments that share a window share such a string, at the same place.
    """
    if not strings:
        return []
    ends = np.cumsum([len(s) for s in strings])
    grams = gram_hashes(np.frombuffer(b"".join(strings), np.uint8)).view(np.int64)
    hits = np.flatnonzero(grams == np.repeat(np.array(names, np.int64), np.diff(ends, prepend=0))[: len(grams)])
    # The anchor is the first gram of its name in the segment.
    places = hits[np.unique(np.searchsorted(ends, hits, side="right"), return_index=True)[1]]
    anchors = (places - np.append(0, ends[:-1])).tolist()
    found: set[int] = set()
    for low in range(0, window - GRAM + 1, STEP):
        high = min(low + STEP - 1, window - GRAM)
        held: dict[tuple[int, bytes], int] = {}
        for i, (name, piece, anchor) in enumerate(zip(names, strings, anchors, strict=True)):
            end = anchor + window - high
            if anchor >= low and end <= len(piece):
                first = held.setdefault((name, piece[anchor - low : end]), i)
                if first != i:
                    found |= {first, i}
    return sorted(found)


SPANS = "row long, content long, begin int, end int"


def _spans_of(places: np.ndarray, start: int, window: int) -> list[tuple[int, int]]:
    """Spans of bytes from places of repeated windows, neighbours joined."""
    if not len(places):
        return []
    breaks = np.flatnonzero(np.diff(places) > 1)
    firsts = places[np.concatenate([[0], breaks + 1])]
    lasts = places[np.concatenate([breaks, [len(places) - 1]])]
    return [(start + a, start + b + window) for a, b in zip(firsts.tolist(), lasts.tolist(), strict=True)]


def _index_blocks(group_rows: DataFrame, params: SubstringParams) -> DataFrame:
    """Spans found by a run-length index over whole anchors, block by block, of the segments that may share a window."""
    dealt = group_rows.repartition("name").sortWithinPartitions("name", "s1", "s2")

    def block(names: list[tuple], strings: list[bytes]) -> Iterator[tuple]:
        own = _sharing([name for name, *_ in names], strings, params.window)
        different = list(dict.fromkeys(strings[i] for i in own))
        found = dict(zip(different, long_matches(different, params.window) if different else (), strict=True))
        for i in own:
            _, row, content, start = names[i]
            for begin, end in _spans_of(found[strings[i]], start, params.window):
                yield row, content, begin, end

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * 4
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["row", "content", "begin", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: list[tuple] = []
        strings: list[bytes] = []
        size, last = 0, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("name", "row", "content", "start", "bytes")]
            for name, row, content, start, piece in zip(*columns, strict=True):
                if size >= params.block and name != last:
                    yield as_batch(list(block(names, strings)))
                    names, strings, size = [], [], 0
                names.append((name, row, content, start))
                strings.append(piece)
                size, last = size + len(piece), name
        if strings:
            yield as_batch(list(block(names, strings)))

    return dealt.select("name", "row", "content", "start", "bytes").mapInArrow(run, SPANS)


# Windows of a segment that are looked at together before they are counted one by one.
NEIGHBOURS = 32


def _shared_blocks(hot: DataFrame, params: SubstringParams) -> DataFrame:
    """``row, content, start, rows, bytes, u1, u2``: blocks of neighbouring windows whose common bytes occur twice at the same
    place from the anchor, and a hash of all their bytes. Equal windows are in such blocks; of the windows around a quoted
    passage few are."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        names = ("row", "content", "name", "start", "rows", "bytes")
        for row, content, name, start, rows, piece in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
            grams = gram_hashes(np.frombuffer(piece, np.uint8)).view(np.int64)
            anchor = int(np.flatnonzero(grams == name)[0])
            last = len(piece) - params.window
            for block in range((anchor - last) // NEIGHBOURS, anchor // NEIGHBOURS + 1):
                # Windows that begin between these two places; both ends of their common bytes follow from the block.
                low, high = max(anchor - (block + 1) * NEIGHBOURS + 1, 0), min(anchor - block * NEIGHBOURS, last)
                core = anchor - block * NEIGHBOURS, anchor - (block + 1) * NEIGHBOURS + 1 + params.window
                key, whole = b"%d %d" % (name, block), piece[low : high + params.window]
                digest = hashlib.blake2b(piece[core[0] : core[1]], digest_size=16, key=key).digest()
                digest += hashlib.blake2b(whole, digest_size=16, key=b"%s %d" % (key, anchor - low)).digest()
                out.append((row, content, start + low, rows, whole, *np.frombuffer(digest, np.int64).tolist()))
        columns = zip(*out, strict=True) if out else [()] * 9
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        labels = ["row", "content", "start", "rows", "bytes", "c1", "c2", "u1", "u2"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], labels)

    schema = "row long, content long, start int, rows long, bytes binary, c1 long, c2 long, u1 long, u2 long"
    blocks = map_batches(hot.select("row", "content", "name", "start", "rows", "bytes"), step, schema, "bytes", 256 << 10)
    blocks = written(blocks, "blocks")
    shared = blocks.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("c1", "c2")
    return blocks.join(written(shared, "shared"), ["c1", "c2"], "left_semi").drop("c1", "c2")


def _whole_blocks(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of blocks that repeat as a whole, one for each; and one of each different block, ``rows`` as often as it occurs."""
    blocks = written(blocks, "shared-blocks")
    place = F.min(F.struct("row", "content", "start")).alias("place")
    folded = blocks.groupBy("u1", "u2").agg(F.sum("rows").alias("rows"), place, F.any_value("bytes").alias("bytes"))
    folded = written(folded.select("u1", "u2", "rows", "place.*", "bytes"), "different-blocks")
    repeated = written(folded.where("rows > 1").select("u1", "u2"), "repeated-blocks")
    found = blocks.where("rows = 1").join(repeated, ["u1", "u2"], "left_semi")
    spans = found.select("row", "content", F.col("start").alias("begin"), (F.col("start") + F.length("bytes")).alias("end"))
    return spans, folded


def _count_windows(hot: DataFrame, params: SubstringParams) -> DataFrame:
    """Spans found by counting 128-bit hashes of whole windows. Blocks that repeat as a whole are counted, but found already."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pieces = batch.column("bytes").to_pylist()
        counts = np.array([len(p) - params.window + 1 for p in pieces], np.int64)
        digests = b"".join(
            hashlib.blake2b(p[i : i + params.window], digest_size=16).digest() for p, n in zip(pieces, counts.tolist(), strict=True) for i in range(n)
        )
        hashes = np.frombuffer(digests, np.int64).reshape(-1, 2)
        taken = np.repeat(np.arange(len(pieces)), counts)
        inner = np.arange(len(taken)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = batch.column("start").to_numpy()[taken] + inner
        columns = [batch.column(c).take(pa.array(taken)) for c in ("row", "content", "rows")] + [pa.array(at.astype(np.int32))]
        columns += [pa.array(np.ascontiguousarray(hashes[:, i])) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, ["row", "content", "rows", "at", "w1", "w2"])

    windows = map_batches(hot.select("row", "content", "start", "rows", "bytes"), step, "row long, content long, rows long, at int, w1 long, w2 long", "bytes", 256 << 10)
    windows = written(windows, "windows")
    repeated = windows.groupBy("w1", "w2").agg(F.sum("rows").alias("all")).where("all > 1").select("w1", "w2")
    found = windows.where("rows = 1").join(repeated, ["w1", "w2"], "left_semi")
    return found.select("row", "content", F.col("at").alias("begin"), (F.col("at") + params.window).alias("end"))


def repeated_spans(rows: DataFrame, params: SubstringParams) -> DataFrame:
    """``row, content, begin, end``: spans of bytes, which may overlap, whose union is what repeats."""
    # Written, so that texts are cut into segments once, not for each of two readers.
    parts = written(_segments(rows, params), "segments")
    twice = parts.groupBy("name").agg(F.sum(F.size("starts")).alias("rows")).where("rows > 1").select("name")
    # Written, so that adaptive execution can split an anchor that very many documents have.
    chosen = parts.join(written(twice, "anchors"), "name", "left_semi")
    cuts = written(_cut(rows, chosen, params), "cuts")
    sizes = written(cuts.groupBy("name", "s1", "s2").agg(F.sum("times").alias("rows")), "sizes")
    whole = sizes.where("rows > 1").select("name", "s1", "s2")
    spans = cuts.join(whole, ["name", "s1", "s2"], "left_semi").select("row", "content", F.inline("spans"))
    different = sizes.groupBy("name").agg(F.count(F.lit(1)).alias("different")).where("different > 1")
    known = sizes.join(written(different, "different"), "name")
    first = F.col("spans")[0]["begin"].alias("start")
    held = cuts.where("bytes is not null").select("row", "content", "name", "s1", "s2", first, "bytes").join(known, ["name", "s1", "s2"])
    # One of each segment, however many batches sent its bytes; one that occurs more than once is found already.
    held = written(held.dropDuplicates(["name", "s1", "s2"]), "held")
    few = _index_blocks(held.where(F.col("different") <= params.gathered), params)
    hot = held.where(F.col("different") > params.gathered)
    runs, blocks = _whole_blocks(_shared_blocks(hot, params))
    return spans.union(few).union(runs).union(_count_windows(blocks, params))


def substring_dedup(docs: DataFrame, params: SubstringParams = SubstringParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, spans, kept`` for every row: what was cut out (begin, end in bytes) and what is left.

    Strings are judged on the input: every copy goes, the first as well. ``kept`` is
    binary, for a cut may fall inside a character. Null texts count as empty; texts
    shorter than the window are left whole. Rows that repeat are copies of each
    other. An empty table gives no rows.
    """
    rows = _keyed(docs, id_col, text_col)
    spans = repeated_spans(rows, params).groupBy("row", "content").agg(F.collect_set(F.struct("begin", "end")).alias("found"))
    joined = rows.join(spans, ["row", "content"], "left").select("id", "text", "found")
    kind = dict(joined.dtypes)["id"]

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[], [], [], []]
        for text, found in zip(_binary(batch), batch.column("found").to_pylist(), strict=True):
            union = _union([(f["begin"], f["end"]) for f in found or ()])
            edges = [0, *[e for span in union for e in span], len(text)]
            kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            for column, value in zip(out, (len(text), len(text) - len(kept), _span_list(union), kept), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.list_(SPAN_FIELDS), pa.binary())
        columns = [batch.column("id"), *[pa.array(c, k) for c, k in zip(out, kinds, strict=True)]]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    schema = f"doc_id {kind}, n_bytes long, n_removed long, spans {SPAN_TYPE}, kept binary"
    return map_batches(joined, step, schema, "text", 4 << 20)
