"""timestamp parsing and type coercion as Column expressions (JVM-side)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.constants import TZ_OFFSETS


def replace_zone_names(raw: Column) -> Column:
    """Plain substring replace of named zones by fixed offsets, in the fixed order."""
    out = F.trim(raw)
    for abbr, offset in TZ_OFFSETS:
        out = F.replace(out, F.lit(abbr), F.lit(offset))
    return out


def parse_timestamp(raw: Column) -> Column:
    """F1 without the fallback: epoch seconds, or an ISO string (named zones replaced).

    Returns a TIMESTAMP (UTC instant) or null when unparseable; naive strings are
    read as UTC (the session time zone).
    """
    s = raw.cast("string")
    is_epoch = s.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    # Any number of decimals, or an exponent; rounded half-even to microseconds, as Python does.
    seconds = F.trim(s).try_cast("decimal(28,9)")
    epoch = F.timestamp_micros(F.bround(seconds * 1_000_000).try_cast("bigint"))
    return F.when(s.isNull(), F.lit(None).cast("timestamp")).when(is_epoch, epoch).otherwise(parse_iso(s))


def parse_iso(text: Column) -> Column:
    """An ISO string (named zones replaced) as a TIMESTAMP, or null; naive strings are read as UTC."""
    return F.try_to_timestamp(replace_zone_names(text))


def parse_timestamp_or(raw: Column, as_of: dt.datetime) -> tuple[Column, Column]:
    """F1 with the fallback: unparseable or missing -> ``as_of`` (the pinned "now").

    Returns ``(timestamp, parse_failed)`` so callers can keep the flag.
    """
    parsed = parse_timestamp(raw)
    failed = parsed.isNull()
    return F.coalesce(parsed, F.lit(as_of).cast("timestamp")), failed


def coerce_value(key: Column, value: Column) -> Column:
    """F2 for one ``(key, string value)`` pair of a payload map.

    ``*_at`` / ``timestamp`` keys become a UTC timestamp string; all-digit strings
    lose leading zeros (read as an integer); null stays null.
    """
    is_time = key.endswith("_at") | (key == "timestamp")
    ts = parse_timestamp(value)
    # Rendered as Python prints an aware UTC datetime: fraction only when non-zero, "+00:00".
    frac = F.unix_micros(ts) % 1_000_000 != 0
    as_text = F.concat(
        F.when(frac, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")).otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")), F.lit("+00:00")
    )
    digits = value.rlike(r"^[0-9]+$")
    return (
        F.when(value.isNull(), value)
        .when(is_time, as_text)
        .when(digits, F.coalesce(F.try_to_number(value, F.lit("9" * 38)).cast("decimal(38,0)").cast("string"), value))
        .otherwise(value)
    )


def coerce_types(payload: Column) -> Column:
    """F2 over a ``MAP<STRING,STRING>`` payload."""
    return F.transform_values(payload, lambda k, v: coerce_value(k, v))
