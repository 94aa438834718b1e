"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

Documents with the same set of shingles are one class. Of each class only a
prefix of its set enters the product: with all shingles in one order, two sets
that reach the threshold share one among their first
``n - ceil(t * n) + 1``. The order is by hash, with frequent shingles last, so a
passage that many documents share is rarely in a prefix. Incidence rows are
partitioned by shingle (the blocks of the product); overlap counts are summed by
pair, and pairs that the sizes and places rule out are dropped before any full set
is looked at.

A large group of near copies is first joined to one member by each list (as many
pairs as rows); after that only pairs of different components meet. Every link
between different components is found that way, so components are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_batches, pieces, small_batches, text_or_empty, written
from .components import components
from .shingles import compact, most_common, set_name, shingle_sets


@dataclass(frozen=True)
class JoinParams:
    """``percent``: the similarity from which sets link. ``frequent``: documents from which a shingle goes last in the
    order; of those the ``most_frequent`` first ones, which bounds what is sent to the tasks. ``star_rounds`` come before the
    product, and more of them, up to ``most_rounds``, while each adds at least this ``gain`` to the links found so far.
    Any choice gives the same links."""

    words: int = 4
    percent: int = 85
    frequent: int = 4
    most_frequent: int = 1_000_000
    star_rounds: int = 2
    most_rounds: int = 8
    gain: float = 0.05
    broadcast_classes: int = 500_000


def _least(size: Column | np.ndarray | int, percent: int):
    """The smallest size that can link with ``size``: ceil(percent * size / 100), in whole numbers."""
    if isinstance(size, Column):
        return F.floor((size * percent + 99) / 100).cast("int")
    return (size * percent + 99) // 100


# Bits of a shingle by which counting rows are told apart: shorter keys take less room, and a clash costs no link.
KEY_BITS = 40


def _key(values: np.ndarray) -> np.ndarray:
    return values & ((1 << KEY_BITS) - 1)


def _key_column(shingle: str) -> Column:
    return F.col(shingle).bitwiseAND(F.lit((1 << KEY_BITS) - 1))


def _prefix(values: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the order: by hash, but those with a frequent key (sorted) after all others."""
    if not len(values):
        return values
    size = len(values) - _least(len(values), percent) + 1
    if len(frequent):
        keys = _key(values)
        last = frequent[np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)] == keys
        values = np.concatenate([values[~last], values[last]])
    return values[:size]


def _sets_of(batch: pa.RecordBatch, params: JoinParams) -> list[np.ndarray]:
    return shingle_sets(batch.column("text").cast(pa.binary()).to_pylist(), params.words)


# Bytes of text that a task hashes at once.
SLICE = 512 << 10
# Shingles that a task counts together; only those that repeat among them are sent on.
CHUNK = 2_000_000


def _frequent(texts: DataFrame, params: JoinParams) -> np.ndarray:
    """Keys of the most frequent shingles, sorted: of those that repeat within a chunk of neighbouring documents, the ones
    that do so most often over all documents. A shingle that a share of the documents has repeats in nearly every chunk."""

    def repeated(held: np.ndarray) -> pa.RecordBatch:
        held.sort()
        # Only places of runs are kept, so that beside the shingles there is little more than a byte for each.
        edges = np.flatnonzero(np.diff(held[1:] == held[:-1], prepend=False, append=False))
        begin, end = edges[::2], edges[1::2]
        return pa.RecordBatch.from_arrays([pa.array(held[begin]), pa.array(end - begin + 1)], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = np.empty(CHUNK, np.int64), 0
        for batch in batches:
            for part in pieces(batch, "text", SLICE):
                for keys in map(_key, _sets_of(part, params)):
                    while len(keys):
                        taken = min(len(keys), CHUNK - size)
                        held[size : size + taken] = keys[:taken]
                        keys, size = keys[taken:], size + taken
                        if size == CHUNK:
                            yield repeated(held)
                            size = 0
        if size:
            yield repeated(held[:size])

    partial = texts.select("text").mapInArrow(run, "key long, n long")
    counts = partial.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= params.frequent)
    with small_batches(texts.sparkSession):
        top = counts.orderBy(F.desc("n"), "key").limit(params.most_frequent).select("key").toPandas()
    return np.sort(top["key"].to_numpy(np.int64))


def _named(texts: DataFrame, keys: np.ndarray, params: JoinParams, salt: int) -> DataFrame:
    """``id, name, check, n, prefix`` of every document; name is null without shingles."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sets = _sets_of(batch, params)
        heads = [_prefix(values, keys, params.percent) for values in sets]
        offsets = pa.array(np.cumsum([0, *map(len, heads)]).astype(np.int32))
        prefix = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(heads) if heads else np.zeros(0, np.int64)))
        names = [set_name(s, salt) if len(s) else (None, None) for s in sets]
        columns = [pa.array([n[i] for n in names], pa.int64()) for i in (0, 1)]
        sizes = pa.array([len(s) for s in sets], pa.int32())
        yield pa.RecordBatch.from_arrays([batch.column("id"), *columns, sizes, prefix], ["id", "name", "check", "n", "prefix"])

    kind = dict(texts.dtypes)["id"]
    return written(map_batches(texts, step, f"id {kind}, name long, check long, n int, prefix array<long>", "text", SLICE), "classes")


def _classes(texts: DataFrame, keys: np.ndarray, params: JoinParams) -> tuple[DataFrame, int]:
    """``id, name, n, prefix`` of every document, and the salt under which no two different sets share a name."""
    salt = 0
    while True:
        named = _named(texts, keys, params, salt)
        checks = named.where("n > 0").groupBy("name").agg(F.min("check").alias("low"), F.max("check").alias("high"))
        if checks.where("low < high").limit(1).count() == 0:
            return named.drop("check"), salt
        salt += 1


def _incidence(classes: DataFrame) -> DataFrame:
    """``shingle, name, n, at``: shared entries of all prefixes, one for each class."""
    # Documents of one class fold here, before the shuffle: a group of copies does not make its shingles' lists long.
    entries = classes.where("n > 0").select("name", "n", "prefix").distinct().select("name", "n", F.posexplode("prefix").alias("at", "shingle"))
    shared = entries.groupBy(_key_column("shingle").alias("key")).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("key")
    rows = entries.withColumn("key", _key_column("shingle")).join(written(shared, "shared"), "key", "left_semi")
    return written(rows.select("shingle", "name", "n", "at"), "incidence")


def _labelled(rows: DataFrame, labels: DataFrame, params: JoinParams) -> DataFrame:
    """The rows of lists that several components share, for only there are pairs left.

    With the class's ``component``; ``before``, how many of its earlier entries are
    left too (the others are in no set of another component whose prefix reaches as
    far); and ``alone``, how many of its prefix are not left.
    """
    placed = rows.join(labels, rows["name"] == labels["node"], "left").select(
        "shingle", "name", "n", "at", F.coalesce("component", "name").alias("component")
    )
    several = placed.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    # A written side lets adaptive execution split a long list, where an aggregate of the same partitioning would not.
    left = placed.join(written(several.select("shingle"), "several"), "shingle", "left_semi")
    own = Window.partitionBy("name")  # a class has as many rows as its prefix
    left = left.withColumn("before", F.row_number().over(own.orderBy("at")) - 1)
    left = left.withColumn("alone", F.col("n") - _least(F.col("n"), params.percent) + 1 - F.count(F.lit(1)).over(own))
    return written(left, "lists")


def _no_labels(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("name").alias("node"), F.col("name").alias("component")).limit(0)


def _possible(n: Column, n_b: Column, most: Column, params: JoinParams) -> Column:
    """Whether an overlap of at most ``most`` can reach the threshold: 100 * overlap >= percent * union."""
    return (100 + params.percent) * most >= params.percent * (n + n_b)


def _star(rows: DataFrame, params: JoinParams, step: int) -> DataFrame:
    """``a, b`` and their sizes: each class with one class of another component in each list. As many pairs as rows at most.

    That one is first the class that has least of its own, the likely source of a
    group of copies, then another one by hash.
    """
    rank = F.lit(0) if step else F.col("alone")
    first = F.min(F.struct(rank.alias("rank"), F.xxhash64("name", F.lit(step)).alias("h"), "name", "n", "at", "before", "component"))
    chosen = written(rows.groupBy("shingle").agg(first.alias("p")), "star")
    pairs = rows.join(chosen, "shingle").where(F.col("component") != F.col("p.component"))
    n, n_b = F.col("p.n"), F.col("n")
    most = F.least("before", "p.before") + F.least(n - F.col("p.at"), n_b - F.col("at"))
    pairs = pairs.where(_possible(n, n_b, most, params))
    return pairs.select(F.col("p.name").alias("a"), F.col("name").alias("b"), n.alias("n_a"), n_b.alias("n_b")).distinct()


def _product(rows: DataFrame, params: JoinParams) -> DataFrame:
    """``a, b`` and their sizes: pairs of different components whose overlap may reach the threshold.

    From the first entry that two sets share there must be enough left in either to
    reach it; a shared entry too late for that adds nothing.
    """
    rows = rows.drop("alone", "before")
    right = rows.select("shingle", *[F.col(c).alias(f"{c}_b") for c in rows.columns if c != "shingle"])
    n, n_b = F.col("n"), F.col("n_b")
    after = F.least(n - F.col("at"), n_b - F.col("at_b"))
    meet = (F.col("name") < F.col("name_b")) & (F.col("component") != F.col("component_b"))
    pairs = rows.join(right, "shingle").where(meet & _possible(n, n_b, after, params))
    counted = pairs.groupBy(F.col("name").alias("a"), F.col("name_b").alias("b"), "n", "n_b").agg(
        F.count(F.lit(1)).alias("same"), F.max("at").alias("at"), F.max("at_b").alias("at_b")
    )
    # Of all shared entries of the prefixes the last one leaves the least.
    return counted.where(_possible(n, n_b, F.col("same") - 1 + after, params)).select("a", "b", n.alias("n_a"), "n_b")


def _sets(
    texts: DataFrame, classes: DataFrame, salt: int, pairs: DataFrame, params: JoinParams, as_bytes: Callable[[np.ndarray], bytes]
) -> DataFrame:
    """``name, set``: the sets of the classes in ``pairs``, from one document of each."""
    wanted = pairs.select(F.col("a").alias("name")).union(pairs.select(F.col("b").alias("name"))).distinct()
    chosen = classes.where("n > 0").groupBy("name").agg(F.min("id").alias("rep")).join(wanted, "name", "left_semi")
    chosen = written(chosen, "chosen")
    if chosen.count() <= params.broadcast_classes:
        chosen = F.broadcast(chosen)
    found = texts.join(chosen, F.col("id").eqNullSafe(F.col("rep"))).select("name", "text")

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        names = batch.column("name").to_pylist()
        sets = _sets_of(batch, params)
        # Rows that repeat the id with another text are not the class's document.
        own = [i for i, s in enumerate(sets) if len(s) and set_name(s, salt)[0] == names[i]]
        columns = [pa.array([names[i] for i in own], pa.int64()), pa.array([as_bytes(sets[i]) for i in own], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["name", "set"])

    return written(map_batches(found, step, "name long, set binary", "text", SLICE), "sets").dropDuplicates(["name"])


def _reach(
    pairs: DataFrame, sets: DataFrame, params: JoinParams, overlap: Callable[[bytes, bytes], int]
) -> DataFrame:
    """The pairs whose overlap, as ``overlap`` has it, reaches the threshold."""
    one = sets.select(F.col("name").alias("a"), F.col("set").alias("set_a"))
    both = pairs.join(one, "a").join(sets.select(F.col("name").alias("b"), F.col("set").alias("set_b")), "b")

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        a, b, n_a, n_b = (batch.column(c).to_pylist() for c in ("set_a", "set_b", "n_a", "n_b"))
        same = [overlap(x, y) for x, y in zip(a, b, strict=True)]
        good = [i for i, s in enumerate(same) if 100 * s >= params.percent * (n_a[i] + n_b[i] - s)]
        yield batch.select(["a", "b", "n_a", "n_b"]).take(pa.array(good, pa.int64()))

    return map_batches(both.select("a", "b", "n_a", "n_b", "set_a", "set_b"), step, "a long, b long, n_a int, n_b int", "set_a", 8 << 20)


def _exact(a: bytes, b: bytes) -> int:
    return len(np.intersect1d(np.frombuffer(a, np.int64), np.frombuffer(b, np.int64), assume_unique=True))


def _links(pairs: DataFrame, texts: DataFrame, classes: DataFrame, salt: int, params: JoinParams) -> DataFrame:
    """The pairs whose full sets reach the threshold: first by compacted sets, which never count too few, then exactly."""
    pairs = written(pairs, "pairs")
    likely = written(_reach(pairs, _sets(texts, classes, salt, pairs, params, compact), params, most_common), "likely")
    whole = _sets(texts, classes, salt, likely, params, np.ndarray.tobytes)
    return _reach(likely, whole, params, _exact).select("a", "b")


def jaccard_components(docs: DataFrame, params: JoinParams = JoinParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row.

    Null and empty texts have no shingles and stand alone. Rows with the same set
    link, rows that repeat among them. A component's number is the smallest id in
    it; null ids count only where there is no other. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    classes, salt = _classes(texts, _frequent(texts, params), params)
    rows = _incidence(classes)
    links, known, grown = None, 0, True
    for step in range(params.most_rounds + 1):
        star = step < params.star_rounds or (grown and step < params.most_rounds)
        left = _labelled(rows, components(links) if links is not None else _no_labels(rows), params)
        found = _links(_star(left, params, step) if star else _product(left, params), texts, classes, salt, params)
        links = written(found if links is None else links.union(found), "links")
        if not star:
            break
        total = links.count()
        known, grown = total, total >= (1 + params.gain) * known
    labels = components(links)
    # Classes without links are their own components.
    own = classes.where("n > 0").groupBy("name").agg(F.min("id").alias("first"))
    placed = own.join(labels, F.col("name") == F.col("node"), "left").withColumn("component", F.coalesce("component", "name"))
    smallest = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    named = placed.select("name", "component").join(smallest, "component").select("name", "component_id")
    out = classes.select("id", "n", "name").join(named, "name", "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))
