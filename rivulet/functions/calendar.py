"""Days, leads and durations as column expressions."""

from __future__ import annotations

import re
from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"


def universal_day(ts: Column) -> Column:
    """1 to 366, the same number for a date in any year: days after 28 February count one more outside leap years."""
    day, year = F.dayofyear(ts), F.year(ts)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return F.when(~leap & (day > 59), day + 1).otherwise(day).cast("int")


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Whole seconds from start to end, for timestamps with or without a zone."""
    return F.timestamp_diff("SECOND", start, end).cast("long")


def lead_seconds(frame: Column) -> Column:
    """Lead of a frame token: f018 and f00115 (hours, or hours and minutes), tm02 and tm0130 (before the reference)."""
    digits = F.regexp_extract(frame, r"(\d+)$", 1)
    number = F.when(digits != "", digits.cast("long"))
    minutes = number % 100 * 60 + F.floor(number / 100) * 3600
    ahead = F.when(F.length(digits) > 3, minutes).otherwise(number * 3600)
    back = F.when(F.length(digits) > 2, minutes).otherwise(number * 3600)
    return F.when(frame.startswith("tm"), -back).when(frame.startswith("f"), ahead).cast("long")


def duration_seconds(text: Column) -> Column:
    """Seconds of an ISO 8601 duration of days to seconds; null for other strings."""
    part = lambda k: F.coalesce(F.when(F.regexp_extract(text, ISO, k) != "", F.regexp_extract(text, ISO, k).cast("double")), F.lit(0.0))
    total = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(text.rlike(ISO) & text.rlike(r"\d"), total)


def format_duration(seconds: Column) -> Column:
    s = seconds.cast("long")
    return F.format_string("P%02dDT%02dH%02dM%02dS", F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60), s % 60)


def parse_duration(text: str) -> timedelta:
    m = re.fullmatch(ISO.strip("^$"), text)
    if not m or not any(m.groups()):
        raise ValueError(f"'{text}' is no ISO 8601 duration")
    d, h, mi, s = (float(x or 0) for x in m.groups())
    return timedelta(days=d, hours=h, minutes=mi, seconds=s)


def date_parts(name: str, ts: Column) -> dict[str, Column]:
    """Template variables of a time: <name>__date, __hour, __minute, __second, __day, __month, __year."""
    parts = {"date": "yyyyMMdd", "hour": "HH", "minute": "mm", "second": "ss", "day": "dd", "month": "MM", "year": "yyyy"}
    return {f"{name}__{k}": F.date_format(ts, f) for k, f in parts.items()}
