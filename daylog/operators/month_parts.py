"""Monthly parts of per-user figures: sums, counts and dates that merge into the figures of the whole history.

A run reads and replaces the months that changed; a user's figures then come from one small row a month. Sums are decimals,
so merging gives the same means to the last bit as one pass over all days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import EXACT_MEAN, is_truthy_number
from .trends import CHARTED, averaged_values, valid_value

#: The means of ``averages``, in their order.
AVERAGED = ("avg_steps", "avg_resting_hr", "avg_sleep_hours", "avg_workout_duration_minutes", "avg_calories_burned")

MONTH_PARTS = ", ".join(
    ["user_id bigint", "date date"]
    + [f"{name}_sum decimal(38,12), {name}_n bigint" for name in AVERAGED]
    + [f"{c}_sum decimal(38,12), {c}_n bigint, {c}_nonzero bigint, {c}_from date, {c}_to date" for c in CHARTED]
)


def month_parts(daily: DataFrame) -> DataFrame:
    """One row per user and month of ``daily``, dated by the first of the month."""
    days = daily.withColumn("total_calories", F.col("total_calories_burned"))
    parts: list[Column] = []

    def add(name: str, value: Column) -> None:
        parts.append(F.sum(value.cast(EXACT_MEAN)).cast("decimal(38,12)").alias(f"{name}_sum"))
        parts.append(F.count(value).alias(f"{name}_n"))

    for name, value in averaged_values().items():
        add(name, value)
    for name in CHARTED:
        add(name, F.col(name))
        dates = F.when(valid_value(name), F.col("date"))
        parts.append(F.count(F.when(is_truthy_number(F.col(name)), 1)).alias(f"{name}_nonzero"))
        parts += [F.min(dates).alias(f"{name}_from"), F.max(dates).alias(f"{name}_to")]
    return days.groupBy("user_id", F.trunc("date", "month").alias("date")).agg(*parts)


def merged(parts: DataFrame) -> DataFrame:
    """The parts of each user's months as one row."""
    out = []
    for name in parts.columns:
        kind = name.rpartition("_")[2]
        if kind in ("sum", "n", "nonzero"):
            out.append(F.sum(name).alias(name))
        elif kind in ("from", "to"):
            out.append((F.min if kind == "from" else F.max)(name).alias(name))
    return parts.groupBy("user_id").agg(*out)


def _mean(name: str, count: str) -> Column:
    return F.col(f"{name}_sum").cast("double") / F.nullif(F.col(f"{name}_{count}"), F.lit(0))


def averages_of(users: DataFrame) -> DataFrame:
    """The five means, as ``averages`` gives them."""
    return users.select("user_id", *(F.coalesce(_mean(name, "n"), F.lit(0.0)).alias(name) for name in AVERAGED))


def user_means_of(users: DataFrame) -> DataFrame:
    """Overall means with zeros counted, as ``with_user_means`` gives them."""
    return users.select("user_id", *(_mean(c, "n").alias(f"{c}_total_average") for c in CHARTED))


def reference_lines_of(users: DataFrame) -> DataFrame:
    """Means with zeros counted as missing, as ``reference_lines`` gives them."""
    return users.select("user_id", *(_mean(c, "nonzero").alias(f"avg_{c}") for c in CHARTED))


def valid_ranges_of(users: DataFrame) -> DataFrame:
    """First and last valid dates, as ``valid_ranges`` gives them."""
    return users.select("user_id", *(f"{c}_{end}" for c in CHARTED for end in ("from", "to")))
