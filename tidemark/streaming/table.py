"""A current-state table fed by a stream of events.

Each batch appends the last event of the keys it touched. Compaction folds finished
batches into a base of hash buckets by key: it writes a new version of the buckets
that the batches touched, and a manifest that names the newest version of each; all
other buckets stay as they are. Readers take the manifest's buckets, those of their
keys only if they name any, and fold the batches after it on top.

Nothing a reader may still hold is overwritten: versions and batches that a manifest
has left behind go when they are older than a grace period (:func:`vacuum_state`).
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.state import current_state, latest_per_key

# Buckets of a new table; a table keeps the number it began with.
BUCKETS = 64
# Manifests kept, written in turn.
SLOTS = 4
MANIFEST = "bucket int, version bigint, buckets int, run int, batch int, part int, moment bigint, slot int"
# The row of a manifest that names no bucket, so that one without buckets has a row too.
HEAD = -1

Place = tuple[int, int, int]
DELTA = ("run", "batch", "part")


@dataclass(frozen=True)
class Manifest:
    """Which version of each bucket holds its keys, and the last part of a batch that is folded in."""

    generation: int = 0
    buckets: int = BUCKETS
    upto: Place | None = None
    moment: int = 0
    versions: dict[int, int] = field(default_factory=dict)


def _missing(problem: Exception) -> bool:
    # The class differs between classic and remote sessions.
    return "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem)


def _read(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame | None:
    reader = spark.read.option("mergeSchema", "false")
    try:
        return (reader.option("basePath", base) if base else reader).parquet(*paths)
    except Exception as problem:
        if _missing(problem):
            return None
        raise


def _delta(path: str, place: Place) -> str:
    return "/".join([f"{path}/delta", *[f"{n}={p}" for n, p in zip(DELTA, place, strict=True)]])


def write_state_batch(events: DataFrame, path: str, batch_id: int, run: int = 0, part: int = 0) -> None:
    """Stores the last event per key of one batch, or of one part of it; a repeated one replaces itself.

    ``events`` has ``key, seq, op, after``. Batch numbers start again with a new
    checkpoint, so a batch is named by its run too; later runs have larger numbers.
    """
    latest_per_key(events).write.mode("overwrite").parquet(_delta(path, (run, batch_id, part)))


def manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """The manifests kept, newest first: a row for each bucket and slot."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").collect()
    except Exception as problem:
        if not _missing(problem):
            raise
        return []
    found = []
    for head in (r for r in rows if r["bucket"] == HEAD):
        versions = {r["bucket"]: r["version"] for r in rows if r["slot"] == head["slot"] and r["bucket"] != HEAD}
        found.append(Manifest(head["version"], head["buckets"], tuple(head[n] for n in DELTA), head["moment"], versions))
    return sorted(found, key=lambda m: -m.generation)


def _save(spark: SparkSession, path: str, manifest: Manifest) -> None:
    same = (manifest.buckets, *manifest.upto, manifest.moment)
    rows = [(b, v, *same) for b, v in [(HEAD, manifest.generation), *manifest.versions.items()]]
    schema = MANIFEST.removesuffix(", slot int")
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    frame.write.mode("overwrite").parquet(f"{path}/manifest/slot={manifest.generation % SLOTS}")


def _bucket(n: int, key: str = "key") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _base(spark: SparkSession, path: str, manifest: Manifest, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of the manifest's buckets, or of some of them. Only their folders are looked at."""
    wanted = manifest.versions if buckets is None else {b: v for b, v in manifest.versions.items() if b in set(buckets)}
    if not wanted:
        return None
    folders = [f"{path}/base/version={v}/bucket={b}" for b, v in sorted(wanted.items())]
    return _read(spark, *folders, base=f"{path}/base").drop("version", "bucket")


def _after(spark: SparkSession, path: str, upto: Place | None) -> DataFrame | None:
    """The batches that are not folded into the base yet."""
    delta = _read(spark, f"{path}/delta")
    if delta is None or upto is None:
        return delta
    later = F.lit(False)
    for name, place in reversed(list(zip(DELTA, upto, strict=True))):
        later = (F.col(name) > place) | ((F.col(name) == place) & later)
    return delta.where(later)


def _union(frames: list[DataFrame | None]) -> DataFrame | None:
    known = [f for f in frames if f is not None]
    if not known:
        return None
    return known[0] if len(known) == 1 else known[0].unionByName(known[1])


def read_state(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame | None:
    """The current row of every live key; with ``keys`` (a column ``key``) of those only, from their buckets alone."""
    newest = next(iter(manifests(spark, path)), Manifest())
    buckets = None
    if keys is not None:
        buckets = [r["b"] for r in keys.select(_bucket(newest.buckets).alias("b")).distinct().collect()]
    delta = _after(spark, path, newest.upto)
    rows = _union([_base(spark, path, newest, buckets), delta.drop(*DELTA) if delta is not None else None])
    if rows is None:
        return None
    if keys is not None:
        rows = rows.join(keys.select("key"), "key", "left_semi")
    return current_state(rows)


def compact_state(spark: SparkSession, path: str, buckets: int = BUCKETS, moment: int | None = None) -> list[int]:
    """Folds the finished batches into the buckets they touch, and returns these. Readers switch once the manifest is whole."""
    newest = next(iter(manifests(spark, path)), Manifest(buckets=buckets))
    delta = _after(spark, path, newest.upto)
    last = None if delta is None else delta.agg(F.max(F.struct(*DELTA)).alias("m")).first()["m"]
    if last is None:
        return []
    upto = tuple(last)
    bucket = _bucket(newest.buckets)
    # At most one number for each bucket.
    touched = sorted(r["b"] for r in delta.select(bucket.alias("b")).distinct().collect())
    rows = current_state(_union([_base(spark, path, newest, touched), delta.drop(*DELTA)]))
    generation = newest.generation + 1
    folder = f"{path}/base/version={generation}"
    placed = rows.withColumn("bucket", bucket).repartition("bucket").sortWithinPartitions("bucket", "key")
    placed.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    # A bucket whose keys are all deleted has no folder.
    written = spark.read.schema("bucket int").parquet(folder).select("bucket").distinct().collect()
    versions = {b: v for b, v in newest.versions.items() if b not in set(touched)}
    versions.update({r["bucket"]: generation for r in written})
    now = time.time_ns() // 1_000_000 if moment is None else moment
    _save(spark, path, Manifest(generation, newest.buckets, upto, now, versions))
    return touched


def vacuum_state(spark: SparkSession, path: str, grace_ms: int, now: int | None = None) -> list[str]:
    """Removes base versions and batches that no manifest of the last ``grace_ms`` needs, and returns their folders.

    A reader may still hold the newest manifest that is older than the grace period,
    and any later one. Deletes through Hadoop's file system, so it works wherever the
    table lies; it needs a classic session.
    """
    clock = time.time_ns() // 1_000_000 if now is None else now
    known = manifests(spark, path)
    old = [m for m in known if m.moment <= clock - grace_ms]
    if not old:
        return []
    safe = old[0]
    needed = {v for m in known if m.generation >= safe.generation for v in m.versions.values()}
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())

    def folders(place) -> list[tuple[int, object]]:
        if not files.exists(place):
            return []
        named = [(s.getPath().getName().partition("=")[2], s.getPath()) for s in files.listStatus(place) if s.isDirectory()]
        return [(int(number), p) for number, p in named if number.isdigit()]

    gone = [p for v, p in folders(hadoop(root, "base")) if v not in needed and v < safe.generation]
    for run, run_path in folders(hadoop(root, "delta")):
        for batch, batch_path in folders(run_path):
            gone += [p for part, p in folders(batch_path) if (run, batch, part) <= safe.upto]
    for place in gone:
        files.delete(place, True)
    return [str(p.toString()) for p in gone]
