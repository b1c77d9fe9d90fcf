"""Timestamps kept as ISO text in the tables."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)?)?$"
)


OFFSET = r":\d{2}(\.\d+)?(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)$"


def parse_iso(s: Column) -> Column:
    """Timestamp of an ISO text; text without an offset is UTC whatever the session zone, bad text is null."""
    timed = F.regexp_replace(F.replace(s, F.lit(","), F.lit(".")), r"^(.{10})$", "$1T00:00:00")
    full = F.regexp_replace(timed, r"^(.{13}:\d{2})(Z|[+-].*)?$", "$1:00$2")
    zoned = F.when(full.rlike(OFFSET), full).otherwise(F.concat(full, F.lit("Z")))
    return F.when(s.rlike(ISO_SHAPE), F.try_to_timestamp(zoned))


def utc(now: datetime) -> datetime:
    return now.replace(tzinfo=timezone.utc) if now.tzinfo is None else now.astimezone(timezone.utc)


def stamp(now: datetime) -> str:
    """The text written into a table for the moment ``now``."""
    return utc(now).isoformat()


def moment(now: datetime) -> Column:
    return F.lit(utc(now))


def age_seconds(s: Column, now: datetime) -> Column:
    """Seconds from the ISO text to ``now``; null when the text is bad."""
    return (F.unix_micros(moment(now)) - F.unix_micros(parse_iso(s))) / F.lit(1e6)
