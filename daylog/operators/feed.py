"""Long-format metric feed: one row per user, day and metric worth showing."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import NO_DURATION, between_days, short_number, sleep_text
from ..functions.numbers import float_text, is_truthy_number, round_exact, thousands, truncate
from ..schemas import DAY

# Metric types and label signs.
STEPS_SIGN, SLEEP_SIGN, CALORIES_SIGN = "🦶 ", "🛏️ ", "🔥 "
HEART_SIGN, WEIGHT_SIGN, WORKOUT_SIGN = "💓 ", "🍪 ", "🏋 "


def _row(keep: Column, metric: str, label: Column, value: Column) -> Column:
    fields = F.struct(F.lit(metric).alias("metric_type"), label.alias("label"), value.cast("string").alias("value"))
    return F.when(keep, fields)


def _scalar_rows() -> list[Column]:
    """The five number metrics; zero and null give no row."""
    steps, sleep = F.col("steps"), F.col("sleep_hours")
    calories, heart, weight = F.col("total_calories_burned"), F.col("resting_heart_rate"), F.col("bodyweight")

    def row(metric: str, number: Column, label: Column, value: Column) -> Column:
        return _row(is_truthy_number(number), metric, label, value)

    return [
        row("Steps", steps, F.concat(F.lit(STEPS_SIGN), thousands(steps)), steps),
        row("Sleep", sleep, F.concat(F.lit(SLEEP_SIGN), sleep_text(sleep)), float_text(round_exact(sleep, 2))),
        row(
            "Calories",
            calories,
            F.concat(F.lit(CALORIES_SIGN), short_number(calories), F.lit(" cal")),
            truncate(calories),
        ),
        row("Heart Rate", heart, F.concat(F.lit(HEART_SIGN), heart, F.lit(" BPM")), heart),
        row("Weight", weight, F.concat(F.lit(WEIGHT_SIGN), float_text(weight), F.lit(" lbs")), float_text(weight)),
    ]


def _present(rows: list[Column]) -> Column:
    return F.inline(F.filter(F.array(*rows), lambda row: row.isNotNull()))


def scalar_feed(daily: DataFrame) -> DataFrame:
    """The five number metrics of a day, unpivoted without a shuffle."""
    return daily.select(*DAY, _present(_scalar_rows()))


def metric_feed(daily: DataFrame, texts: DataFrame) -> DataFrame:
    """All six metrics of a day in one pass: the numbers, and the workout with its duration as label
    and its text as value."""
    joined = daily.join(texts.select(*DAY, "text"), DAY, "left")
    duration = F.col("total_workout_duration")
    label = F.concat(F.lit(WORKOUT_SIGN), duration)
    workout = _row(duration != NO_DURATION, "Workout", label, F.coalesce("text", F.lit("")))
    return joined.select(*DAY, _present([*_scalar_rows(), workout]))


def on_day(rows: DataFrame, day: datetime.date) -> DataFrame:
    """Rows of one day; no row for an absent day."""
    return between_days(rows, day, day)


def date_spine(users: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """Every day of the range for every user."""
    days = F.sequence(F.lit(first), F.lit(last))
    if last < first:
        days = F.array().cast("array<date>")
    return users.select("user_id", F.explode(days).alias("date"))


def missing_days(daily: DataFrame, first: datetime.date, last: datetime.date) -> DataFrame:
    """Days of the range that a known user has no record of."""
    present = between_days(daily, first, last).select(*DAY)
    return date_spine(daily.select("user_id").distinct(), first, last).join(present, DAY, "left_anti")
