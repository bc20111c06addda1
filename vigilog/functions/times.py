"""Date and time expressions. The session time zone is UTC throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(c: Column) -> Column:
    """ISO-8601 text to timestamp, null when it is missing or not readable."""
    return F.try_to_timestamp(c)


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def clock_text(raw: Column) -> Column:
    """``HH:MM:SS``; the raw text when unreadable, empty when missing."""
    return F.coalesce(F.date_format(parse_iso(raw), "HH:mm:ss"), raw, F.lit(""))


def epoch_text(ts: Column) -> Column:
    """Seconds since the epoch with a fraction and no padding zeros, e.g. ``1744581592.613``."""
    micros = F.unix_micros(ts.cast("timestamp"))
    text = F.format_string("%d.%06d", F.floor(micros / F.lit(1000000)), F.pmod(micros, F.lit(1000000)))
    return F.regexp_replace(text, r"(\.\d+?)0+$", "$1")


def minute(ts: Column) -> Column:
    """Start of the minute, in the type of the input."""
    return F.window(ts, "1 minute")["start"]


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / F.lit(1e6)


def time_bucket(ts: Column, seconds: int, origin: int = 0) -> Column:
    """Number of the fixed window that holds ``ts``, counted from ``origin`` (epoch seconds)."""
    return F.floor((F.unix_seconds(ts.cast("timestamp")) - F.lit(origin)) / F.lit(seconds))
