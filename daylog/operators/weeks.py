"""Weekly muscle volume: set counts, weights, ranks and trends per user.

Sets are reduced per user, date, exercise and muscle list before muscles are exploded, so the
explode and every window run on a table bounded by the calendar and the exercise list.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import muscle_key
from ..functions.dates import between_days, week_bounds, week_start
from ..functions.numbers import exact_sum
from ..schemas import DAY

# Spans of the trailing views, the tracked muscles and the trend length.
TRAILING_DAYS = 30
TRAILING_WEEKS = 4
TRACKED = ("Back", "Chest", "Quads")
TREND_WEEKS = 3


def muscle_days(sets: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    """Sets and weight x reps per key and muscle as written. Muscle-less sets fall out."""
    load = F.coalesce("weight_lbs", F.lit(0.0)) * F.coalesce("reps", F.lit(0))
    reduced = sets.groupBy(*keys, "exercise", "muscle_groups").agg(
        F.count("*").alias("sets"), exact_sum(load).alias("volume")
    )
    return reduced.select(*keys, F.explode("muscle_groups").alias("muscle"), "sets", "volume")


def _per_week(days: DataFrame) -> DataFrame:
    return days.groupBy("user_id", week_start(F.col("date")).alias("week"), "muscle").agg(
        F.sum("sets").alias("sets"), F.sum("volume").cast("double").alias("volume")
    )


def week_figures(sets: DataFrame) -> DataFrame:
    """Sets and weight x reps per user, week and muscle: what is stored by week, and what the weekly views are made of."""
    return _per_week(muscle_days(sets))


def weekly_sets(sets: DataFrame) -> DataFrame:
    return week_figures(sets).select("user_id", "week", "muscle", "sets")


def weekly_sets_trailing(sets: DataFrame, days: int = TRAILING_DAYS) -> DataFrame:
    """Weekly sets of the trailing days, counted from the user's last day with a named muscle."""
    per_day = muscle_days(sets).groupBy(*DAY, "muscle").agg(F.sum("sets").alias("sets"), F.sum("volume").alias("volume"))
    # A user has at most one row per calendar day and muscle here, however many exercises they name.
    newest = F.max("date").over(Window.partitionBy("user_id"))
    recent = per_day.withColumn("newest", newest).filter(F.col("date") >= F.date_sub("newest", days))
    return _per_week(recent.drop("newest")).select("user_id", "week", "muscle", "sets")


def weekly_weight_ranked(sets: DataFrame, weeks: int = TRAILING_WEEKS) -> DataFrame:
    """Weekly weight x reps per muscle of the trailing weeks, ranked within the week."""
    return ranked_of(week_figures(sets), weeks)


def ranked_of(weekly: DataFrame, weeks: int = TRAILING_WEEKS) -> DataFrame:
    newest = F.max("week").over(Window.partitionBy("user_id"))
    recent = weekly.withColumn("newest", newest).filter(F.col("week") >= F.date_sub("newest", 7 * weeks))
    order = Window.partitionBy("user_id", "week").orderBy(F.desc("volume"), F.asc("muscle"))
    return recent.select(
        "user_id", "week", "muscle", F.col("volume").alias("total_weight"), F.row_number().over(order).alias("rank")
    )


def weekly_progress(sets: DataFrame, muscles: Sequence[str] = TRACKED, span: int = TREND_WEEKS) -> DataFrame:
    """Weekly volume of the tracked muscles with the mean of the last ``span`` training weeks."""
    return progress_of(week_figures(sets.filter(F.arrays_overlap("muscle_groups", F.array(*map(F.lit, muscles))))), muscles, span)


def progress_of(weekly: DataFrame, muscles: Sequence[str] = TRACKED, span: int = TREND_WEEKS) -> DataFrame:
    trend = Window.partitionBy("user_id", "muscle").orderBy("week").rowsBetween(1 - span, 0)
    rows = weekly.filter(F.col("muscle").isin(*muscles))
    return rows.select("user_id", "week", "muscle", "volume", F.avg("volume").over(trend).alias("volume_rolling"))


def week_volume(sets: DataFrame, day: datetime.date) -> DataFrame:
    """Sets per normalised muscle in the calendar week of ``day``; the range prunes the scan."""
    monday, sunday = week_bounds(day)
    week = between_days(sets, monday, sunday)
    counts = week.groupBy("user_id", "exercise", "muscle_groups").agg(F.count("*").alias("sets"))
    opened = counts.select("user_id", F.explode("muscle_groups").alias("muscle"), "sets")
    return opened.groupBy("user_id", muscle_key(F.col("muscle")).alias("muscle")).agg(F.sum("sets").alias("sets"))
