"""Timestamp helpers (all JVM-side column expressions).

The data model is wall-clock UTC. Driver tables store TIMESTAMP_NTZ, which
``unix_millis`` and ``withWatermark`` refuse, so loaders convert to TIMESTAMP
with :func:`as_instant` and results handed to SQL comparisons are turned back
with :func:`as_wallclock`. Both are exact in every session zone, at DST
changes too.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F



def _session_tz() -> str:
    spark = SparkSession.getActiveSession()
    return spark.conf.get("spark.sql.session.timeZone", "UTC") if spark else "UTC"


#: A time of day followed by an offset, Z or a zone name.
ZONED = r"\d:\d{2}[^A-Za-z+-]*(?:[+-]\d{1,2}(?::?\d{2}){0,2}|[A-Za-z][A-Za-z0-9_/+:-]*)\s*$"


def _is_utc() -> bool:
    return _session_tz().upper() in ("UTC", "Z", "+00:00", "ETC/UTC", "GMT")


def as_instant(col: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) -> TIMESTAMP, the same in every session zone."""
    c = F.col(col) if isinstance(col, str) else col
    if _is_utc():
        return c.cast("timestamp")
    return F.try_to_timestamp(F.concat(c.cast("timestamp_ntz").cast("string"), F.lit("Z")))


def as_wallclock(col: Column | str) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ holding its UTC wall clock, the same in every session zone."""
    c = F.col(col) if isinstance(col, str) else col
    if _is_utc():
        return c.cast("timestamp_ntz")
    seconds = (F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def parse_timestamp(col: Column | str, fmt: str | None = None) -> Column:
    """String -> TIMESTAMP; malformed input gives NULL instead of aborting.

    ``to_timestamp`` raises ``CAST_INVALID_INPUT`` under ANSI mode, which
    would abort a whole batch before the ``IS NOT NULL`` rule can quarantine
    the row. ``try_to_timestamp`` keeps the row and lets the rule reject it.
    Text without a zone offset is read as UTC wall clock (the data model),
    independent of the session time zone; text with an offset keeps it.
    """
    c = F.col(col) if isinstance(col, str) else col
    text = c.cast("string")
    if fmt is not None:
        return F.try_to_timestamp(text, F.lit(fmt))
    wall = text.try_cast("timestamp_ntz")          # would drop a zone, so only for text without one
    return F.when(text.rlike(ZONED), F.try_to_timestamp(F.trim(text))).otherwise(as_instant(wall))


def epoch_millis(col: Column | str) -> Column:
    """TIMESTAMP -> epoch milliseconds (sub-millisecond part truncated)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.unix_millis(c)


def truncate_ms(col: Column | str) -> Column:
    """Drop sub-millisecond precision, like a ``yyyy-MM-dd HH:mm:ss.SSS``
    string round trip, but without leaving the timestamp domain."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_trunc("millisecond", c)


def format_wallclock(col: Column | str) -> Column:
    """TIMESTAMP -> ``yyyy-MM-ddTHH:mm:ss.SSSSSS`` text of its UTC wall clock
    (no offset), the inverse of :func:`parse_timestamp`."""
    text = as_wallclock(col).cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."),
                    F.rpad(F.substring(text, 21, 6), 6, "0"))


def strip_event_time(col: Column | str) -> Column:
    """The time at millisecond precision as a fresh expression.

    Used before a second streaming stage: a rebuilt value carries no
    event-time (watermark) metadata from the upstream stream. Going through
    epoch milliseconds instead of text keeps it exact in every session zone.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_millis(F.unix_millis(c))
