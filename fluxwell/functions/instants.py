"""ISO-8601 instants and time arguments."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: UTC instant with seconds and up to nine fraction digits.
INSTANT = r"^(?:\d{4}|[+-]\d{4,6})-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(?:\.\d{0,9})?[Zz]$"


def parse_instant(text: str) -> Column:
    """Timestamp of a strict UTC instant in SQL expression ``text``, else NULL.

    Offsets, date-only and space-separated forms are refused although a plain cast takes
    them; lower-case letters, midnight written as 24:00:00 and a leap second are accepted.
    """
    bare = f"regexp_replace(upper({text}), r'\\.?Z$', 'Z')"
    return F.expr(
        f"""CASE WHEN {text} RLIKE r'{INSTANT}' THEN coalesce(
          try_cast({text} AS timestamp),
          CASE WHEN {text} RLIKE r'[Tt]24:00:00(?:\\.0*)?[Zz]$'
                 THEN CAST(date_add(try_cast(left({text}, 10) AS date), 1) AS timestamp)
               WHEN {text} RLIKE r'[Tt]23:59:60'
                 THEN try_cast(replace({bare}, ':60', ':59') AS timestamp)
               ELSE try_cast({bare} AS timestamp) END) END"""
    )


def format_instant(ts: Column) -> Column:
    """UTC instant text with microseconds (session time zone must be UTC)."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def as_timestamp(value) -> Column:
    """Column for an ``as_of`` style argument; None means the query's own clock."""
    if value is None:
        return F.current_timestamp()
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        if value.tzinfo is not None:
            value = value.astimezone(timezone.utc).replace(tzinfo=None)
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def interval(text: str) -> Column:
    """``interval("5 minutes")``; also accepts a sum such as ``"1 hour 30 minutes"``."""
    return F.expr(f"INTERVAL '{text}'")
