"""Where a job starts: the decision rules and staleness."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..config import SNAPSHOT_MODES, CdcConfig
from ..functions.offsets import no_offset, vector_literal
from ..operators.offsets import vectors_stale
from .offset_log import Offset, load_offset, loaded_offset, save_offset, stored_offset

__all__ = [
    "Offset", "StaleOffsetError", "StartPlan", "check_retained", "load_offset", "loaded_offset", "merge_vectors", "normal_mode",
    "plan_start", "save_offset", "start_decision", "stored_offset",
]


class StaleOffsetError(RuntimeError):
    """The log no longer reaches back to the offset to go on from. Not worth a retry."""


def _stale(vector: list[str | None]) -> StaleOffsetError:
    return StaleOffsetError(
        f"the offset {','.join(o or 'null' for o in vector)} is considered stale; take a new snapshot or use the mode when_needed"
    )


def check_retained(vector: list[str | None], oldest: DataFrame) -> None:
    """Raises when a partition's oldest offset still held lies after the one in ``vector``: records between are lost."""
    row = oldest.select(vectors_stale(vector_literal(vector), F.col("offsets")).alias("stale")).first()
    if row is not None and row["stale"]:
        raise _stale(vector)


def normal_mode(mode: Column) -> Column:
    """Mode text trimmed and lower-cased; unknown text counts as ``initial``."""
    clean = F.lower(F.trim(mode))
    return F.when(clean.isin(*SNAPSHOT_MODES), clean).otherwise(F.lit("initial"))


def start_decision(
    mode: Column, has_stored: Column, finished: Column, stale: Column, has_config: Column, all_null: Column
) -> Column:
    """What to do at a start: ``struct<snapshot, stream, start, fail>``.

    ``start`` names the vector to begin with: ``none`` (all null), ``stored``,
    ``config`` (the job's elements over the stored ones) or ``tails`` (the ends
    of the log). A stale stored offset is dropped in mode ``when_needed`` and
    is an error wherever it would be used.
    """
    kind = normal_mode(mode)
    reset = has_stored & stale & (kind == "when_needed")
    stored = has_stored & ~reset
    snapshot = ~(stored & finished) & (kind != "no_data")
    stream = kind != "initial_only"
    start = (
        F.when(snapshot, F.when(stored, "stored").otherwise("none"))
        .when(has_config, "config")
        .when(~stored | all_null, "tails")
        .otherwise("stored")
    )
    fail = stored & stale & (start == "stored") & (snapshot | stream)
    return F.struct(
        snapshot.alias("snapshot"), stream.alias("stream"), start.alias("start"), fail.alias("fail")
    )


def merge_vectors(base: Column, over: Column) -> Column:
    """``over`` where it has an element, else ``base``."""
    return F.zip_with(base, over, lambda b, o: F.coalesce(o, b))


@dataclass(frozen=True)
class StartPlan:
    """The outcome of a start decision."""

    snapshot: bool
    stream: bool
    start: str
    vector: list[str | None]


def plan_start(
    spark: SparkSession,
    config: CdcConfig,
    stored: Offset | None,
    tails: DataFrame | None = None,
    oldest: DataFrame | None = None,
) -> StartPlan:
    """Decides from one-row frames: ``tails`` and ``oldest`` hold an ``offsets`` array each."""
    n = config.partitions
    empty: list[str | None] = [None] * n
    chosen = config.offset_list or empty
    chosen = (chosen + empty)[: max(n, len(chosen))]
    known = spark.range(1).select(
        vector_literal(stored.vector if stored else empty).alias("stored"),
        (tails.select("offsets").scalar() if tails is not None else vector_literal(empty)).alias("tails"),
        (oldest.select("offsets").scalar() if oldest is not None else vector_literal(empty)).alias("oldest"),
        vector_literal(empty).alias("none"),
    )
    facts = known.select(
        "*",
        merge_vectors(F.col("stored"), vector_literal(chosen)).alias("config"),
        start_decision(
            F.lit(config.snapshot_mode),
            F.lit(stored is not None),
            F.lit(stored.finished if stored else False),
            vectors_stale(F.col("stored"), F.col("oldest")),
            F.lit(config.offset_list is not None),
            no_offset("stored"),
        ).alias("d"),
    )
    begin = F.when(F.col("d.start") == "stored", F.col("stored")).when(F.col("d.start") == "config", F.col("config"))
    begin = begin.when(F.col("d.start") == "tails", F.col("tails")).otherwise(F.col("none"))
    row = (
        facts.withColumn("begin", begin)
        .withColumn("late", vectors_stale(F.col("begin"), F.col("oldest")) & (F.col("d.snapshot") | F.col("d.stream")))
        .first()
    )
    decision = row["d"]
    if decision["fail"] or row["late"]:
        raise _stale(row["begin"])
    return StartPlan(decision["snapshot"], decision["stream"], decision["start"], list(row["begin"]))
