"""Facts read back from the ``source`` struct of an event."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .offsets import _col, format_offsets


def ts_ms() -> Column:
    """Processing time in epoch milliseconds; the log carries no commit time."""
    return F.unix_millis(F.current_timestamp())


def event_timestamp(source: Column | str = "source") -> Column:
    """The moment of an event."""
    return F.timestamp_millis(_col(source)["ts_ms"])


def event_txid(source: Column | str = "source") -> Column:
    """The transaction id of an event."""
    return _col(source)["txId"]


def event_position(source: Column | str = "source") -> Column:
    """The offset vector of an event as text."""
    return format_offsets(_col(source)["offsets"])
