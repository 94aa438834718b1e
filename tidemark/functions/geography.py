"""GEOGRAPHY columns: well-known text to well-known binary.

Spark's expressions take the text apart; an Arrow function only lays out the
bytes of a batch. The bytes are big endian, two dimensions per point.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType

from .offsets import _col

# Shape codes of the binary form.
POINT, LINESTRING, POLYGON = 1, 2, 3
# Fixed value: a geometry collection without members, the fallback of NOT NULL columns.
EMPTY_COLLECTION = "010700000000000000"

_NUMBER = r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?"
_PAIR = rf"{_NUMBER}\s+{_NUMBER}"
# Possessive repeats are matched in a loop; plain ones recurse and overflow on long paths.
_RING = rf"\(\s*{_PAIR}(?:\s*,\s*{_PAIR})*+\s*\)"
_FORMS = {
    POINT: rf"(?i)^\s*POINT\s*\(\s*{_PAIR}\s*\)\s*$",
    LINESTRING: rf"(?i)^\s*LINESTRING\s*{_RING}\s*$",
    POLYGON: rf"(?i)^\s*POLYGON\s*\(\s*{_RING}(?:\s*,\s*{_RING})*+\s*\)\s*$",
}


# The Arrow functions are made on call, so they travel by value and executors
# need not have this package installed.
def _point_encoder():
    code = POINT

    @F.arrow_udf(BinaryType())
    def encode(x: pa.Array, y: pa.Array) -> pa.Array:
        rows = np.zeros(len(x), dtype=[("order", "u1"), ("shape", ">u4"), ("x", ">f8"), ("y", ">f8")])
        rows["shape"] = code
        rows["x"] = x.fill_null(0.0).to_numpy(zero_copy_only=False)
        rows["y"] = y.fill_null(0.0).to_numpy(zero_copy_only=False)
        valid = np.asarray(x.is_valid()) & np.asarray(y.is_valid())
        bitmap = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
        ends = np.arange(len(x) + 1, dtype="<i4") * rows.itemsize
        return pa.BinaryArray.from_buffers(
            pa.binary(), len(x), [bitmap, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())]
        )

    return encode


def _path_encoder():
    polygon = POLYGON

    @F.arrow_udf(BinaryType())
    def encode(shape: pa.Array, rings: pa.Array) -> pa.Array:
        """All rings of a batch at once: places follow from sizes, and what is not a head is points, in order."""
        codes = shape.fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
        counts = rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype("i8")
        inner = rings.flatten()
        sizes = np.asarray(inner.value_lengths(), dtype="i8")
        row = np.repeat(np.arange(len(codes)), counts)
        used = codes[row] > 0
        valid = codes > 0
        head = np.where(valid, np.where(codes == polygon, 9, 5), 0)
        # A ring's bytes, none where the row has no shape.
        taken = np.where(used, 4 + 8 * sizes, 0)
        own = np.bincount(row, weights=taken, minlength=len(codes)).astype("i8")
        ends = np.concatenate([[0], np.cumsum(head + own)])
        before = np.cumsum(taken) - taken
        ring_at = np.cumsum(head)[row] + before
        out = np.zeros(ends[-1], "u1")
        is_point = np.ones(ends[-1], bool)

        def put(at: np.ndarray, values: np.ndarray) -> None:
            places = at[:, None] + np.arange(4)
            out[places] = values.astype(">u4").view("u1").reshape(-1, 4)
            is_point[places] = False

        begin = ends[:-1]
        is_point[begin[valid]] = False
        put(begin[valid] + 1, codes[valid])
        put(begin[codes == polygon] + 5, counts[codes == polygon])
        put(ring_at[used], sizes[used] // 2)
        points = inner.flatten().to_numpy(zero_copy_only=False)[np.repeat(used, sizes)]
        out[is_point] = points.astype(">f8").view("u1")
        bitmap = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
        offsets = pa.py_buffer(ends.astype("<i4").tobytes())
        return pa.BinaryArray.from_buffers(pa.binary(), len(codes), [bitmap, offsets, pa.py_buffer(out.tobytes())])

    return encode


def geography_shape(c: Column | str) -> Column:
    """The shape code of readable text, else null."""
    text = _col(c)
    return (
        F.when(text.rlike(_FORMS[POINT]), F.lit(POINT))
        .when(text.rlike(_FORMS[LINESTRING]), F.lit(LINESTRING))
        .when(text.rlike(_FORMS[POLYGON]), F.lit(POLYGON))
    )


def _numbers(text: Column) -> Column:
    found = F.regexp_extract_all(text, F.lit(f"({_NUMBER})"), F.lit(1))
    return F.transform(found, lambda n: n.cast("double"))


def wkt_to_wkb(c: Column | str) -> Column:
    """POINT, LINESTRING or POLYGON text as bytes; other text gives null."""
    text = _col(c)
    shape = geography_shape(text)
    point = F.when(shape == POINT, _numbers(text))
    path_shape = F.when(shape != POINT, shape)
    # One text per ring: the parts between inner brackets.
    ring_texts = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    rings = F.when(shape != POINT, F.transform(ring_texts, _numbers))
    points = _point_encoder()(F.get(point, F.lit(0)), F.get(point, F.lit(1)))
    return F.coalesce(points, _path_encoder()(path_shape, rings))


def point_to_wkb(c: Column | str) -> Column:
    """As :func:`wkt_to_wkb` for columns declared GEOGRAPHYPOINT: one batch call, no loop."""
    text = _col(c)
    point = F.when(text.rlike(_FORMS[POINT]), _numbers(text))
    return _point_encoder()(F.get(point, F.lit(0)), F.get(point, F.lit(1)))


def convert_geography(c: Column | str, mode: str = "geometry", nullable: bool = True, points_only: bool = False) -> Column:
    """``string``: the text. ``geometry``: ``struct<srid, wkb>`` with a null srid.

    Text that is not readable gives a null struct, which the failure mode of
    the job then treats; a missing value of a NOT NULL column gives the empty
    collection.
    """
    text = _col(c)
    if mode == "string":
        return text
    if mode != "geometry":
        raise ValueError(f"unknown geography mode {mode}")
    wkb = point_to_wkb(text) if points_only else wkt_to_wkb(text)
    if not nullable:
        wkb = F.when(text.isNull(), F.unhex(F.lit(EMPTY_COLLECTION))).otherwise(wkb)
    shape = F.struct(F.lit(None).cast("int").alias("srid"), wkb.alias("wkb"))
    return F.when(shape["wkb"].isNotNull(), shape)
