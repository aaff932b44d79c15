"""Muscle names, workout focus and simple flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# Which muscles make a workout a push, pull or leg day.
PUSH = ("chest", "shoulder", "shoulders", "triceps", "front delts", "pec")
PULL = ("back", "biceps", "rear delts", "lats")
LEGS = ("quads", "hamstrings", "glutes", "calves", "legs")
LOW_SLEEP_HOURS = 6.0
STEP_COLOURS = ((10000, "green"), (5000, "orange"))
STEP_COLOUR_BELOW = "red"


def muscle_key(muscle: Column) -> Column:
    return F.when(F.coalesce(muscle, F.lit("")) == "", F.lit("other")).otherwise(F.lower(strip(muscle)))


def focus_of(top_muscle: Column, push=PUSH, pull=PULL, legs=LEGS) -> Column:
    """Focus of a day with at least one set; null muscle means no set named a muscle."""
    return (
        F.when(top_muscle.isNull(), F.lit("other"))
        .when(top_muscle.isin(*push), F.lit("push"))
        .when(top_muscle.isin(*pull), F.lit("pull"))
        .when(top_muscle.isin(*legs), F.lit("legs"))
        .otherwise(top_muscle)
    )


def low_sleep(hours: Column) -> Column:
    return F.coalesce(hours < LOW_SLEEP_HOURS, F.lit(False))


def steps_colour(steps: Column) -> Column:
    (top, top_name), (middle, middle_name) = STEP_COLOURS
    return F.when(steps >= top, top_name).when(steps >= middle, middle_name).otherwise(STEP_COLOUR_BELOW)
