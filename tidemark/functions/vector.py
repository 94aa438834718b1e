"""VECTOR columns: type names, text, arrays and little-endian bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BinaryType

from .binary import convert_binary
from .offsets import _col

# Fixed value: VECTOR(length, element type).
VECTOR_TYPE = r"^VECTOR\((\d+),\s*(I8|I16|I32|I64|F32|F64)\)$"
# Element type -> bytes per element.
ELEMENT_BYTES = {"I8": 1, "I16": 2, "I32": 4, "I64": 8, "F32": 4, "F64": 8}
# Element type -> Spark element type.
ELEMENT_SPARK = {"I8": "tinyint", "I16": "smallint", "I32": "int", "I64": "bigint", "F32": "float", "F64": "double"}
# Element type -> little-endian numpy type.
ELEMENT_NUMPY = {"I8": "i1", "I16": "<i2", "I32": "<i4", "I64": "<i8", "F32": "<f4", "F64": "<f8"}


def parse_vector_type(c: Column | str, strict: bool = True) -> Column:
    """A type name as ``struct<length, element_type, element_bytes, total_bytes>``."""
    name = _col(c)
    length = F.regexp_extract(name, VECTOR_TYPE, 1).try_cast("int")
    element = F.regexp_extract(name, VECTOR_TYPE, 2)
    width = F.lit(None).cast("int")
    for kind, size in ELEMENT_BYTES.items():
        width = F.when(element == kind, F.lit(size)).otherwise(width)
    parsed = F.when(
        name.rlike(VECTOR_TYPE),
        F.struct(
            length.alias("length"),
            element.alias("element_type"),
            width.alias("element_bytes"),
            (length * width).alias("total_bytes"),
        ),
    )
    if not strict:
        return parsed
    problem = F.raise_error(F.concat(F.lit("invalid VECTOR type: "), name))
    shape = "struct<length:int,element_type:string,element_bytes:int,total_bytes:int>"
    return F.when(name.isNotNull() & ~name.rlike(VECTOR_TYPE), problem.cast(shape)).otherwise(parsed)


def parse_vector_json(c: Column | str, element: str) -> Column:
    """JSON array text as a typed array."""
    return F.from_json(_col(c), f"array<{ELEMENT_SPARK[element]}>")


def _encoder(element: str):
    """An Arrow function packing whole batches of arrays into little-endian bytes."""
    dtype = np.dtype(ELEMENT_NUMPY[element])

    @F.arrow_udf(BinaryType())
    def encode(arrays: pa.Array) -> pa.Array:
        flat = arrays.flatten()
        if flat.null_count:
            raise ValueError("a vector cannot hold null elements")
        data = flat.to_numpy(zero_copy_only=False).astype(dtype, copy=False).tobytes()
        valid = np.asarray(arrays.is_valid())
        sizes = np.asarray(arrays.value_lengths().fill_null(0)) * valid * dtype.itemsize
        ends = np.concatenate([[0], np.cumsum(sizes)])
        bitmap = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
        packed = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(arrays), [bitmap, pa.py_buffer(ends.astype("<i8").tobytes()), pa.py_buffer(data)]
        )
        return packed.cast(pa.binary())

    return encode


def convert_vector(c: Column | str, element: str, mode: str = "string", binary_mode: str = "bytes") -> Column:
    """A vector array as JSON text, as a typed array, or as encoded little-endian bytes."""
    typed = _col(c).cast(f"array<{ELEMENT_SPARK[element]}>")
    if mode == "array":
        return typed
    if mode == "string":
        return F.to_json(typed)
    if mode == "binary":
        return convert_binary(_encoder(element)(typed), binary_mode)
    raise ValueError(f"unknown vector mode {mode}")
