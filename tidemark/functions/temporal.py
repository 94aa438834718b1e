"""Dates, times, timestamps and years. The session time zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .offsets import _col

# Display widths that separate second from microsecond precision.
TIME_SECONDS_WIDTH = 10
TIME_MICROS_WIDTH = 17
TIMESTAMP_SECONDS_WIDTH = 19
TIMESTAMP_MICROS_WIDTH = 26
# Fixed value: hours ':' minutes [':' seconds] ['.' fraction].
DURATION = r"^(-?[0-9]+):([0-9]+)(:([0-9]+))?(\.([0-9]*))?$"
EPOCH = "1970-01-01 00:00:00"


def parse_duration(text: Column | str, strict: bool = True) -> Column:
    """A signed duration in microseconds.

    The sign is that of the parsed hour number, so ``-0:30:00`` is plus thirty
    minutes. A fraction counts only after seconds. Text of another form raises,
    or gives null when not ``strict``.
    """
    c = _col(text)
    # One regular expression decides; the parts are then cut at fixed characters.
    clock = F.substring_index(c, ".", 1)
    upto_minutes = F.substring_index(clock, ":", 2)
    hours = F.substring_index(clock, ":", 1).cast("bigint")
    minutes = F.substring_index(upto_minutes, ":", -1).cast("bigint")
    fraction = F.when(clock != c, F.rpad(F.substring_index(c, ".", -1), 6, "0").cast("bigint")).otherwise(F.lit(0))
    seconds = F.substring_index(clock, ":", -1).cast("bigint") * 1000000 + fraction
    rest = minutes * 60000000 + F.when(clock != upto_minutes, seconds).otherwise(F.lit(0))
    total = hours * 3600000000 + rest * F.when(hours >= 0, F.lit(1)).otherwise(F.lit(-1))
    value = F.when(c.rlike(DURATION), total)
    if not strict:
        return value
    problem = F.raise_error(F.concat(F.lit("unexpected format for TIME column: "), c))
    return value.when(c.isNotNull(), problem.cast("bigint"))


def convert_time(micros: Column | str, mode: str = "adaptive", length: int = TIME_SECONDS_WIDTH) -> Column:
    """A duration in microseconds as the mode wants it: milliseconds or microseconds."""
    c = _col(micros)
    if mode == "adaptive_time_microseconds":
        return c
    if mode == "adaptive" and TIME_SECONDS_WIDTH < length <= TIME_MICROS_WIDTH:
        return c
    return _div(c, 1000)


def _div(c: Column, n: int) -> Column:
    """Integer division that cuts toward zero."""
    return F.call_function("div", c, F.lit(n).cast("bigint"))


def convert_date(c: Column | str, mode: str = "adaptive") -> Column:
    """Days since the epoch; mode ``connect`` keeps a date."""
    day = _col(c).cast("date")
    return day if mode == "connect" else F.unix_date(day)


def convert_timestamp(c: Column | str, mode: str = "adaptive", length: int = TIMESTAMP_SECONDS_WIDTH) -> Column:
    """Epoch milliseconds or microseconds by width; ``connect`` keeps a timestamp cut to milliseconds."""
    moment = _col(c).cast("timestamp")
    if mode != "connect":
        if length <= TIMESTAMP_SECONDS_WIDTH:
            return F.unix_millis(moment)
        if length <= TIMESTAMP_MICROS_WIDTH:
            return F.unix_micros(moment)
    return F.date_trunc("millisecond", moment)


def convert_year(c: Column | str, source: str = "number") -> Column:
    """A year from a date, from text or from a number."""
    column = _col(c)
    return F.year(column) if source == "date" else column.cast("int")


def parse_default_date(c: Column | str, nullable: bool = True) -> Column:
    """Default text of a DATE column; unreadable text gives null, or the epoch if null is not allowed."""
    text = _col(c)
    day = F.when(text.rlike(_DEFAULT_FORM), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))
    if nullable:
        return day
    return F.when(text.isNotNull(), F.coalesce(day, F.lit("1970-01-01").cast("date")))


def parse_default_datetime(c: Column | str, nullable: bool = True) -> Column:
    """Default text of a DATETIME or TIMESTAMP column, see :func:`parse_default_date`."""
    text = _col(c)
    moment = F.when(text.rlike(_DEFAULT_FORM), text.try_cast("timestamp"))
    if nullable:
        return moment
    return F.when(text.isNotNull(), F.coalesce(moment, F.lit(EPOCH).cast("timestamp")))


# Fixed value: yyyy-MM-dd with an optional time after one blank.
_DEFAULT_FORM = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"
