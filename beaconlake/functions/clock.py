"""UTC time: explicit ``as_of``, half-open day ranges, range strings and bucket labels.

Nothing here reads the wall clock. Callers pass ``as_of``; naive datetimes count as UTC. Range bounds become
literals on the raw column, so Parquet statistics and date partitions can prune the scan.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
DAY = timedelta(days=1)
DAY_MS = 86_400_000

_LEADING_INTEGER = re.compile(r"\s*([+-]?\d+)")


def utc(at: datetime) -> datetime:
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def midnight(at: datetime) -> datetime:
    return utc(at).replace(hour=0, minute=0, second=0, microsecond=0)


def epoch_ms(at: datetime) -> int:
    return (utc(at) - EPOCH) // timedelta(milliseconds=1)


def at_ms(ms: int) -> datetime:
    return EPOCH + timedelta(milliseconds=ms)


def yesterday(as_of: datetime) -> tuple[datetime, datetime]:
    """The last complete UTC day before ``as_of`` as [since, until)."""
    until = midnight(as_of)
    return until - DAY, until


def utc_midnight(day: date) -> datetime:
    return datetime(day.year, day.month, day.day, tzinfo=timezone.utc)


def within(df: DataFrame, since: datetime | None, until: datetime | None) -> DataFrame:
    """Rows of a raw table with ``since <= timestamp < until``; None leaves that side open.

    A table partitioned by ``event_date`` also gets the matching date bounds, so whole partitions are skipped.
    """
    dated = "event_date" in df.columns
    if since is not None:
        df = df.where(F.col("timestamp") >= epoch_ms(since))
        if dated:
            df = df.where(F.col("event_date") >= F.lit(utc(since).date()))
    if until is not None:
        df = df.where(F.col("timestamp") < epoch_ms(until))
        if dated:
            df = df.where(F.col("event_date") <= F.lit((utc(until) - timedelta(milliseconds=1)).date()))
    return df


def parse_days(text: str, default: int = 7) -> int:
    """Days in a range string: leading integer, else the default. '24h' is 24 days here, '0' is the default."""
    found = _LEADING_INTEGER.match(text)
    days = int(found[1]) if found else 0
    if days < 0:
        raise ValueError(f"negative range: {text!r}")
    return days or default


def is_last_day(text: str) -> bool:
    """True for the range strings that mean the last 24 hours in the reads that know it."""
    return text.lower() == "24h"


def days_back(as_of: datetime, days: int):
    """First calendar date of a range that reaches ``days`` back from today (so it spans days + 1 dates)."""
    return (midnight(as_of) - days * DAY).date()


def event_date(timestamp_ms: Column) -> Column:
    """UTC date of epoch milliseconds, by integer arithmetic: the session time zone plays no part."""
    return F.date_from_unix_date(((timestamp_ms - F.pmod(timestamp_ms, F.lit(DAY_MS))) / DAY_MS).try_cast("int"))


def utc_day(at: Column) -> Column:
    """UTC date of a timestamp, whatever the session time zone."""
    return event_date(F.unix_millis(at))


def label(at: Column, pattern: str) -> Column:
    """A timestamp in UTC, whatever the session time zone; ``pattern`` knows yyyy, MM, dd, HH, mm and ss."""
    day = utc_day(at).cast("string")
    second = F.pmod(F.unix_seconds(at), F.lit(86400))

    def two(value: Column) -> Column:
        return F.lpad(F.floor(value).cast("string"), 2, "0")

    fields = {
        "yyyy": F.substring(day, 1, 4), "MM": F.substring(day, 6, 2), "dd": F.substring(day, 9, 2),
        "HH": two(second / 3600), "mm": two(second % 3600 / 60), "ss": two(second % 60),
    }
    parts = [part for part in re.split("(yyyy|MM|dd|HH|mm|ss)", pattern) if part]
    return F.concat(*(fields[part] if part in fields else F.lit(part) for part in parts))


def parse_timestamp(text: Column) -> Column:
    """Both stored forms, 'YYYY-MM-DD HH:MM:SS' in UTC and ISO 'YYYY-MM-DDTHH:MM:SS.mmmZ'; NULL when neither."""
    zoned = text.rlike(r"(Z|[+-]\d{2}:?\d{2})\s*$")
    return F.when(zoned, text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp")


def stamp(at: Column) -> Column:
    return label(at, "yyyy-MM-dd HH:mm:ss")


def week_label(day: Column) -> Column:
    """'YYYY-Www' of a date, with Monday-based weeks numbered 00-53; days before the first Monday are week 00."""
    week = F.floor((F.dayofyear(day) + 6 - F.weekday(day)) / 7)
    return F.concat(F.year(day).cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0"))


def seven_day_span(last: Column) -> Column:
    """Display span of the seven days that end on a date: 'YYYY.MM.DD - YYYY.MM.DD'."""
    return F.concat(
        F.date_format(F.date_sub(last, 6), "yyyy.MM.dd"), F.lit(" - "), F.date_format(last, "yyyy.MM.dd")
    )
