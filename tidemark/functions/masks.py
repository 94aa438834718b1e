"""Masking and truncation of text columns. Null input stays null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .offsets import _col


def mask_hash(c: Column | str, algorithm: str, salt: str) -> Column:
    """Hex digest of the salt followed by the value."""
    salted = F.concat(F.lit(salt), _col(c).cast("string"))
    name = algorithm.upper().replace("-", "")
    if name == "MD5":
        return F.md5(salted)
    if name in ("SHA", "SHA1"):
        return F.sha1(salted)
    if name in ("SHA224", "SHA256", "SHA384", "SHA512"):
        return F.sha2(salted, int(name[3:]))
    raise ValueError(f"unknown hash algorithm {algorithm}")


def mask_chars(c: Column | str, n: int) -> Column:
    """Exactly ``n`` asterisks, whatever the length of the value."""
    return F.when(_col(c).isNotNull(), F.lit("*" * n))


def truncate_chars(c: Column | str, n: int) -> Column:
    """The first ``n`` characters."""
    return F.substring(_col(c), 1, n)
