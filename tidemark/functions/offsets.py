"""Offset text and offset vectors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# An offset element is hex digits or the word null.
HEX_ELEMENT = "^[0-9a-fA-F]+$"
NULL_ELEMENT = "null"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_hex(c: Column | str) -> Column:
    """Bytes as lower-case hex; null stays null."""
    return F.lower(F.hex(_col(c)))


def parse_offsets(c: Column | str, any_case: bool = False) -> Column:
    """Comma-joined text to an array; the text ``null`` becomes a null element.

    Stored offsets spell it in lower case; a job option may spell it in any case.
    """

    def element(e: Column) -> Column:
        spelled = F.lower(e) if any_case else e
        return F.when(spelled != NULL_ELEMENT, e)

    return F.transform(F.split(_col(c), ","), element)


def format_offsets(c: Column | str) -> Column:
    """An offset vector as comma-joined text, also the position of an event."""
    return F.array_join(_col(c), ",", NULL_ELEMENT)


def invalid_offsets(c: Column | str) -> Column:
    """Elements of an ``offsets`` option that are neither hex nor ``null``."""
    text = _col(c)
    parts = F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ","))
    return F.filter(parts, lambda e: ~e.rlike(HEX_ELEMENT) & (F.lower(e) != NULL_ELEMENT))


def no_offset(c: Column | str) -> Column:
    """True when every element of the vector is null."""
    return F.forall(_col(c), lambda e: e.isNull())


def vector_literal(offsets: list[str | None]) -> Column:
    """A vector known on the driver (one element per database partition)."""
    return F.array(*[F.lit(o).cast("string") for o in offsets])
