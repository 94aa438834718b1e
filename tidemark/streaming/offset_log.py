"""The log of offsets: a few slots that are written in turn.

Each save has the next version and replaces the oldest slot, so the newest whole one
stays readable while its successor is written. A start reads the slots, however many
batches there have been, and folders never grow in number.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.offsets import format_offsets, parse_offsets, vector_literal

# Fixed value: one stored offset.
STORED = "txId string, offsets string, snapshot boolean, partitionId int, snapshot_completed boolean"
# What else a slot holds: where the run began, how far it has come, and its place among the saves.
PLACE = "run int, batch int, part int, whole boolean, frontier bigint, held bigint, beat bigint, start string, version bigint"
SLOTS = 4


def stored_offset(
    tx_id: Column, offsets: Column, partition_id: Column, snapshot: Column, completed: Column
) -> Column:
    """An offset in the form it is stored: joined text; the snapshot flag only while true."""
    return F.struct(
        tx_id.alias("txId"),
        format_offsets(offsets).alias("offsets"),
        F.when(snapshot, F.lit(True)).alias("snapshot"),
        partition_id.cast("int").alias("partitionId"),
        completed.alias("snapshot_completed"),
    )


def loaded_offset(stored: Column) -> Column:
    """A stored offset as values: the vector as an array, missing flags as false."""
    return F.struct(
        stored["txId"].alias("txId"),
        parse_offsets(stored["offsets"]).alias("offsets"),
        stored["partitionId"].cast("int").alias("partitionId"),
        F.coalesce(stored["snapshot"], F.lit(False)).alias("snapshot"),
        F.coalesce(stored["snapshot_completed"], F.lit(False)).alias("snapshot_completed"),
    )


@dataclass(frozen=True)
class Offset:
    """A loaded offset on the driver: one value per database partition, and how far its run has come.

    ``part`` counts the parts of a batch that is written in several, ``whole`` says
    that the batch is finished. ``frontier`` is the highest arrival number emitted,
    ``held`` how many records wait, ``beat`` the interval of the last heartbeat, and
    ``start`` the vector the run began with.
    """

    vector: list[str | None]
    tx_id: str | None = None
    partition_id: int | None = None
    snapshot: bool = False
    completed: bool = True
    run: int = 0
    batch: int = 0
    part: int = 0
    whole: bool = True
    frontier: int | None = None
    held: int = 0
    beat: int | None = None
    start: list[str | None] | None = None
    version: int = field(default=-1, compare=False)

    @property
    def finished(self) -> bool:
        """No snapshot is under way."""
        return not (self.snapshot and not self.completed)

    @property
    def first_vector(self) -> list[str | None]:
        return self.vector if self.start is None else self.start


def _slot(state: str, version: int) -> str:
    return f"{state}/offsets/slot={version % SLOTS}"


def _saved(spark: SparkSession, state: str) -> DataFrame | None:
    """The whole slots. One that is being replaced has no file and gives no row."""
    try:
        return spark.read.schema(f"{STORED}, {PLACE}, slot int").parquet(f"{state}/offsets")
    except Exception as problem:  # the class differs between classic and remote sessions
        if "PATH_NOT_FOUND" in str(problem):
            return None
        raise


def save_offset(spark: SparkSession, state: str, offset: Offset) -> Offset:
    """Stores an offset as the newest one and returns it with its version."""
    version = offset.version
    if version < 0:
        newest = load_offset(spark, state)
        version = -1 if newest is None else newest.version
    saved = replace(offset, version=version + 1)
    names = [f.split()[0] for f in PLACE.split(", ")]
    start = format_offsets(vector_literal(saved.start)) if saved.start is not None else F.lit(None)
    place = [(start if n == "start" else F.lit(getattr(saved, n))).cast(f.split()[1]).alias(n) for n, f in zip(names, PLACE.split(", "))]
    row = stored_offset(
        F.lit(saved.tx_id).cast("string"),
        vector_literal(saved.vector),
        F.lit(saved.partition_id).cast("int"),
        F.lit(saved.snapshot),
        F.lit(saved.completed),
    )
    frame = spark.range(1).select(row.alias("o"), *place).select("o.*", *names)
    frame.coalesce(1).write.mode("overwrite").parquet(_slot(state, saved.version))
    return saved


def load_offset(spark: SparkSession, state: str, run: int | None = None, batch: int | None = None) -> Offset | None:
    """The newest stored offset; with a run and batch the newest of that batch, as long as a slot still has it."""
    saved = _saved(spark, state)
    if saved is None:
        return None
    if run is not None:
        saved = saved.where(F.col("run") == run)
    if batch is not None:
        saved = saved.where(F.col("batch") == batch)
    names = [f.split()[0] for f in PLACE.split(", ") if not f.startswith("start ")]
    values = saved.select(loaded_offset(F.struct("*")).alias("o"), parse_offsets(F.col("start")).alias("start"), *names)
    rows = values.collect()  # one for each slot at most
    if not rows:
        return None
    found = max(rows, key=lambda r: r["version"])
    o = found["o"]
    start = None if found["start"] is None else list(found["start"])
    return Offset(
        list(o["offsets"]), o["txId"], o["partitionId"], o["snapshot"], o["snapshot_completed"], start=start, **{n: found[n] for n in names}
    )
