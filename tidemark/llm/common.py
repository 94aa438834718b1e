"""What several operators share: reading, written intermediates, and Arrow steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path

# ASCII white space as the contracts name it, inside a character class.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str | Column) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


# Bytes of an Arrow batch in steps that run at once. Spark's bound is by rows, so a batch's memory would follow the texts'
# length, in the executor and in its Python workers.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What is run inside sends Arrow batches of ``BATCH_BYTES`` at most (and a row more); the session's setting returns."""
    before = spark.conf.get(BATCH_CONF, None)
    if before is not None and before.isdigit() and 0 < int(before) <= BATCH_BYTES:
        yield
        return
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def written(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written as Parquet to the cluster's shared folder and read back: lineage ends here.

    The files stay until the owner of ``spark.checkpoint.dir`` clears it, for the
    result is read lazily.
    """
    path = fresh_path(frame.sparkSession, label)
    with small_batches(frame.sparkSession):
        frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores in front as keep them apart from the frame's columns, whatever their case."""
    taken = {c.lower() for c in frame.columns}
    mark = "__"
    while any(f"{mark}{n}".lower() in taken for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]


Slices = Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]


def pieces(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of about ``most`` bytes of text (one row at least), so that memory follows bytes, not rows."""
    column = batch.column(batch.schema.get_field_index(text))
    if not batch.num_rows:
        return
    sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(zero_copy_only=False)
    start = taken = 0
    for row, size in enumerate(sizes):
        if row > start and taken + size > most:
            yield batch.slice(start, row - start)
            start, taken = row, 0
        taken += int(size)
    yield batch.slice(start)


def map_batches(
    frame: DataFrame, step: Slices, schema: str, text: str | None = None, most: int = 4 << 20, after: Callable[[], None] | None = None
) -> DataFrame:
    """``mapInArrow`` of a step that turns one record batch into others, cut by bytes of ``text`` if that is named.

    ``after`` is called when a task ends: Python workers outlive it, with whatever the step keeps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in pieces(batch, text, most) if text else (batch,):
                    yield from step(part)
        finally:
            if after:
                after()

    return frame.mapInArrow(run, schema)
