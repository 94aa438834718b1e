"""Binary, bit and base64 conversions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .offsets import _col, to_hex


def convert_binary(c: Column | str, mode: str = "bytes") -> Column:
    """Bytes as they are, or as base64, URL-safe base64 or lower-case hex text.

    ``base64`` breaks its output into lines, so the line ends are taken out;
    whole-text replacement is several times faster here than ``translate``.
    """
    data = _col(c)
    if mode == "bytes":
        return data
    if mode == "hex":
        return to_hex(data)
    if mode in ("base64", "base64-url-safe"):
        text = F.replace(F.base64(data), F.lit("\r\n"), F.lit(""))
        if mode == "base64":
            return text
        return F.replace(F.replace(text, F.lit("+"), F.lit("-")), F.lit("/"), F.lit("_"))
    raise ValueError(f"unknown binary mode {mode}")


def reverse_bytes(c: Column | str) -> Column:
    """The bytes in opposite order."""
    pairs = F.regexp_extract_all(F.hex(_col(c)), F.lit("(..)"), F.lit(1))
    return F.unhex(F.array_join(F.reverse(pairs), ""))


def convert_bit(c: Column | str, big_endian_input: bool = False) -> Column:
    """BIT values as little-endian bytes."""
    return reverse_bytes(c) if big_endian_input else _col(c)
