"""Default text of a column as a value of the column's converted type."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import LongType, StringType, StructField

from ..config import CdcConfig
from .offsets import _col
from .temporal import convert_date, convert_timestamp, parse_default_date, parse_default_datetime, parse_duration
from .types import BINARIES, GEOGRAPHIES, TIMESTAMPS, base_type_name, convert_column, type_arguments, vector_element
from .vector import parse_vector_json


def parse_default(text: Column | str, type_name: str, nullable: bool, config: CdcConfig, length: int = 0) -> Column:
    """Default text through the same conversion as the column's values.

    Struct results (geometry) become null, because a struct cannot be a default.
    """
    c = _col(text)
    base = base_type_name(type_name)
    width = length or (26 if type_arguments(type_name) == [6] else 19)
    if base == "DATE":
        return convert_date(parse_default_date(c, nullable), config.time_mode)
    if base in TIMESTAMPS:
        return convert_timestamp(parse_default_datetime(c, nullable), config.time_mode, width)
    if base in GEOGRAPHIES and config.geography_mode == "geometry":
        return F.lit(None).cast("struct<srid:int,wkb:binary>")
    if base == "VECTOR":
        if config.vector_mode == "string":
            return c
        c = _required(parse_vector_json(c, vector_element(type_name)), c, type_name)
    elif base == "TIME":
        c = parse_duration(c)
    elif base == "BIT" or base in BINARIES:
        c = F.encode(c, "UTF-8")
    kind = LongType() if base == "TIME" else StringType()
    return convert_column(StructField("text", kind, True, {"type": type_name, "length": length}), config, c)


def _required(parsed: Column, text: Column, type_name: str) -> Column:
    """Raises where text could not be read; an unreadable default is no null."""
    problem = F.raise_error(F.concat(F.lit(f"unreadable default of {type_name}: "), text))
    return F.when(text.isNotNull() & parsed.isNull(), problem).otherwise(parsed)
