"""Daily trends and averages per user: rolling means, reference lines, ranges and the dashboard row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import NO_DURATION, duration_minutes, hours_minutes_text
from ..functions.effort import DEFAULT_BODY_KG, fallback_set_calories
from ..functions.numbers import (
    EXACT_MEAN,
    above_zero,
    exact_mean,
    exact_sum,
    fixed,
    is_truthy_number,
    mean_skip_zero,
    round_exact,
    round_whole,
    truncate,
    truthy_or,
)
from ..schemas import DAY
from .dims import attach_dim

# Trend length in rows, charted columns, and the least calories of a valid day.
ROLLING_ROWS = 7
CHARTED = ("steps", "sleep_hours", "total_calories")
VALID_CALORIES = 100


def averaged_values() -> dict[str, Column]:
    """What each of the five means is taken over: the value of a valid day, null on other days."""
    calories_valid = F.col("calories_burned_from_steps") != 0
    worked = F.col("total_workout_duration") != NO_DURATION
    minutes = duration_minutes(F.col("total_workout_duration"))
    return {
        "avg_steps": above_zero(F.col("steps")),
        "avg_resting_hr": above_zero(F.col("resting_heart_rate")),
        "avg_sleep_hours": above_zero(F.col("sleep_hours")),
        "avg_workout_duration_minutes": above_zero(minutes, worked),
        "avg_calories_burned": above_zero(F.col("total_calories_burned"), calories_valid),
    }


def averages(daily: DataFrame) -> DataFrame:
    """Five means over valid days of each user in one pass; 0 where no day is valid."""
    means = [F.coalesce(exact_mean(value), F.lit(0.0)).alias(name) for name, value in averaged_values().items()]
    return daily.groupBy("user_id").agg(*means)


def averages_lines(means: DataFrame) -> DataFrame:
    """Averages as the published text, one row per block."""
    workout = F.col("avg_workout_duration_minutes")
    blocks = {
        "steps": F.concat(F.lit("Average Daily Steps: "), round_whole(F.col("avg_steps"))),
        "resting_hr": F.concat(F.lit("Average Resting Heart Rate: "), round_whole(F.col("avg_resting_hr"))),
        "sleep": F.concat(F.lit("Average Sleep: "), hours_minutes_text(F.col("avg_sleep_hours") * 60)),
        "workout_duration": F.concat(F.lit("Average Workout Duration: "), hours_minutes_text(workout)),
        "calories": F.concat(F.lit("Average Calories Burned: "), round_whole(F.col("avg_calories_burned"))),
    }
    return _lines(means, blocks)


def averages_report(means: DataFrame) -> DataFrame:
    """Averages as the console report, one row per line."""
    minutes = F.col("avg_workout_duration_minutes")
    duration = F.format_string(
        "- Workout Duration: %d hr %d min", truncate(F.floor(minutes / 60)), truncate(F.pmod(minutes, F.lit(60.0)))
    )
    lines = {
        "steps": F.concat(F.lit("- Steps: "), fixed(F.col("avg_steps"), 0)),
        "resting_hr": F.concat(F.lit("- Resting HR: "), fixed(F.col("avg_resting_hr"), 1), F.lit(" bpm")),
        "sleep": F.concat(F.lit("- Sleep Duration: "), fixed(F.col("avg_sleep_hours"), 2), F.lit(" hours")),
        "workout_duration": duration,
        "calories": F.concat(F.lit("- Calories Burned: "), fixed(F.col("avg_calories_burned"), 0)),
    }
    return _lines(means, lines)


def _lines(means: DataFrame, blocks: dict[str, Column]) -> DataFrame:
    rows = [F.struct(F.lit(name).alias("block"), text.alias("text")) for name, text in blocks.items()]
    return means.select("user_id", F.inline(F.array(*rows)))


def set_totals(sets: DataFrame, dim: DataFrame, body_kg: float = DEFAULT_BODY_KG) -> DataFrame:
    """Sets, reps, weight x reps and fallback energy of each day in one pass."""
    reps = F.coalesce("reps", F.lit(0))
    energy = fallback_set_calories(F.col("met"), reps, body_kg)
    return (
        attach_dim(sets, dim)
        .groupBy(*DAY)
        .agg(
            F.count("*").alias("total_sets"),
            F.sum(reps).cast("bigint").alias("total_reps"),
            exact_sum(F.coalesce("weight_lbs", F.lit(0.0)) * reps).cast("double").alias("total_weight_lifted"),
            round_exact(exact_sum(energy).cast("double"), 1).alias("fallback_calories"),
        )
    )


def dashboard_days(daily: DataFrame, totals: DataFrame) -> DataFrame:
    """One dashboard row per user and day; energy falls back on the estimate when none is stored."""
    fallback = F.coalesce("fallback_calories", F.lit(0.0))
    stored = F.col("calories_burned_from_workout").cast("double")
    return daily.join(totals, DAY, "left").select(
        *DAY,
        "steps",
        "distance",
        F.col("calories_burned_from_steps").alias("wearable_calories"),
        truthy_or(stored, fallback).alias("workout_calories"),
        F.col("total_calories_burned").alias("total_calories"),
        "sleep_hours",
        "sleep_score",
        "workout_title",
        F.coalesce("total_sets", F.lit(0)).alias("total_sets"),
        F.coalesce("total_reps", F.lit(0)).alias("total_reps"),
        F.coalesce("total_weight_lifted", F.lit(0.0)).alias("total_weight_lifted"),
    )


def rolling_means(days: DataFrame, columns: Sequence[str] = CHARTED, rows: int = ROLLING_ROWS) -> DataFrame:
    """Mean of the last ``rows`` rows (not days) of each user, nulls skipped.

    A user's rows are days, so a window is bounded by the calendar however hot the user is.
    """
    window = Window.partitionBy("user_id").orderBy("date").rowsBetween(1 - rows, 0)
    return days.withColumns({f"{c}_rolling": F.avg(c).over(window) for c in columns})


def with_user_means(days: DataFrame, columns: Sequence[str] = CHARTED) -> DataFrame:
    """Each user's overall mean as a column: a user holds at most one row per calendar day, so the
    window needs the one shuffle that the rolling means already made."""
    window = Window.partitionBy("user_id")

    def mean(name: str) -> Column:
        total = F.sum(F.col(name).cast(EXACT_MEAN)).over(window).cast("double")
        return total / F.nullif(F.count(name).over(window), F.lit(0))

    return days.withColumns({f"{c}_total_average": mean(c) for c in columns})


def reference_lines(days: DataFrame, columns: Sequence[str] = CHARTED) -> DataFrame:
    """Mean per user with zeros counted as missing; null when no value is left."""
    return days.groupBy("user_id").agg(*(mean_skip_zero(F.col(c)).alias(f"avg_{c}") for c in columns))


def reference_labels(lines: DataFrame) -> DataFrame:
    """Reference lines as chart labels; a user without values has none."""
    return lines.select(
        "user_id",
        F.concat(F.lit("Avg Calories: "), truncate(F.col("avg_total_calories"))).alias("calories_label"),
        F.concat(F.lit("Avg Steps: "), truncate(F.col("avg_steps"))).alias("steps_label"),
        F.concat(F.lit("Avg Sleep: "), fixed(F.col("avg_sleep_hours"), 1), F.lit("h")).alias("sleep_label"),
    )


def valid_value(name: str, zero_is_valid: bool = False) -> Column:
    """Whether a day counts for a charted column."""
    if zero_is_valid:
        return F.col(name).isNotNull()
    return F.col(name) > VALID_CALORIES if name == "total_calories" else is_truthy_number(F.col(name))


def valid_ranges(days: DataFrame, columns: Sequence[str] = CHARTED, zero_is_valid: bool = False) -> DataFrame:
    """First and last valid date per user and charted column, all columns in one pass."""
    found = []
    for name in columns:
        dates = F.when(valid_value(name, zero_is_valid), F.col("date"))
        found += [F.min(dates).alias(f"{name}_from"), F.max(dates).alias(f"{name}_to")]
    return days.groupBy("user_id").agg(*found)
