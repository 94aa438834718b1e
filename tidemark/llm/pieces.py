"""Subword encoding and decoding with offsets.

Documents are encoded where they lie, in one pass without a shuffle: batches of a
few MB of text go through the model that ``piece_model`` reads. Normalisation
records where each byte came from, so every piece has the span of source bytes it
stands for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, text_or_empty
from .piece_model import load


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode_pieces(
    docs: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",), text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """``keep`` columns, then ``ids``, ``starts``, ``ends`` (arrays of int; byte spans in the source), and ``decoded``.

    Every row is encoded over its whole text, without begin or end ids. The spans
    are in order and cover the text; the pieces of a character that is written as
    bytes are empty but for the last. Null texts count as empty and give empty
    arrays. Repeated rows stay. An empty table gives no rows. Names of ``keep``
    may not be those of the added columns.
    """
    added = ("ids", "starts", "ends", "decoded")
    if set(keep) & set(added):
        raise ValueError(f"columns to keep clash with {added}")
    data = Path(model_path).read_bytes()
    load(data)  # an unreadable model fails here, not in the tasks
    rows = docs.select(*keep, text_or_empty(text_col).alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields]
    schema = ", ".join([*fields, "ids array<int>", "starts array<int>", "ends array<int>", *["decoded string"] * decoded])

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = load(data)
        ids, starts, ends, offsets = model.encode_many(batch.column(batch.num_columns - 1).to_pylist())
        columns = batch.columns[:-1] + [_lists(v, offsets) for v in (ids, starts, ends)]
        if decoded:
            limits = offsets.tolist()
            columns.append(pa.array([model.decode(ids[a:b]) for a, b in zip(limits, limits[1:], strict=False)], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, [*keep, *added[: 3 + decoded]])

    return map_batches(rows, step, schema, "__text", 1 << 20, after=lambda: load(data).forget())


def decode_pieces(frame: DataFrame, model_path: str, keep: Sequence[str] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and ``decoded``, the text of the ids; null ids give null, empty ones an empty text."""
    data = Path(model_path).read_bytes()
    rows = frame.select(*keep, F.col(ids_col).alias("__ids"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.select(*keep).schema.fields]

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        model = load(data)
        ids = batch.column(batch.num_columns - 1).to_pylist()
        texts = [None if i is None else model.decode(np.array(i, np.int32)) for i in ids]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*keep, "decoded"])

    return map_batches(rows, step, ", ".join([*fields, "decoded string"]))
