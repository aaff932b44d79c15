"""Dates, calendar weeks and durations."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numbers import fixed, round_whole, truncate

# The time format of the set log and the text of an empty duration.
LOG_TIME = "d MMM yyyy, H:mm"
NO_DURATION = "0:00"


def iso_date(text: Column) -> Column:
    """Date of a ``yyyy-MM-dd`` text; null for every other text."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text))


def log_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit(LOG_TIME)).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def duration_text(minutes: Column) -> Column:
    """Minutes as ``h:mm``, both parts taken toward the lower hour as in a clock."""
    hours = F.floor(minutes / 60)
    return F.format_string("%d:%02d", hours, minutes - hours * 60)


def duration_minutes(text: Column) -> Column:
    """``h:mm`` as minutes; null when unreadable."""
    parts = F.split(text, ":")
    return F.get(parts, F.lit(0)).try_cast("bigint") * 60 + F.get(parts, F.lit(1)).try_cast("bigint")


def milliseconds_to_hours(ms: Column) -> Column:
    return ms / 1000 / 60 / 60


def week_start(date: Column) -> Column:
    """Monday of the date's week."""
    return F.date_trunc("week", date).cast("date")


def iso_year(date: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), date)


def iso_week(date: Column) -> Column:
    return F.weekofyear(date)


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def between_days(rows: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """Rows of a range of days. A stored table also has its ``month``, whose range prunes folders."""
    kept = rows.filter(F.col("date").between(F.lit(first), F.lit(last)))
    if "month" in rows.columns:
        kept = kept.filter(F.col("month").between(f"{first:%Y-%m}", f"{last:%Y-%m}"))
    return kept


def week_bounds(day: datetime.date) -> tuple[datetime.date, datetime.date]:
    """First and last day of the calendar week of ``day``: a date range the scan can prune by."""
    monday = day - datetime.timedelta(days=day.weekday())
    return monday, monday + datetime.timedelta(days=6)


def as_date(day: str | datetime.date) -> datetime.date:
    return day if isinstance(day, datetime.date) else datetime.date.fromisoformat(day)


def hours_minutes_text(minutes: Column) -> Column:
    """``1 hr 20 min``, or ``45 min`` below one hour. Minutes are rounded, so 60 min can appear."""
    hours = truncate(F.floor(minutes / 60))
    rest = F.format_string("%d min", round_whole(F.pmod(minutes, F.lit(60.0))))
    return F.when(hours != 0, F.concat(hours.cast("string"), F.lit(" hr "), rest)).otherwise(rest)


def sleep_text(hours: Column) -> Column:
    whole = truncate(hours)
    return F.format_string("%d hr %d min", whole, round_whole((hours - whole) * 60))


def short_number(number: Column) -> Column:
    """``1.2M``, ``9.3k`` or the whole number."""
    return (
        F.when(number >= 1_000_000, F.concat(fixed(number / 1_000_000, 1), F.lit("M")))
        .when(number >= 1000, F.concat(fixed(number / 1000, 1), F.lit("k")))
        .otherwise(truncate(number).cast("string"))
    )
