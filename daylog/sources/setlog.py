"""Set-log rows -> typed log rows, workouts and sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import duration_text, log_timestamp, minutes_between
from ..functions.numbers import blank_to_null
from ..schemas import DAY


def parse_set_log(rows: DataFrame) -> DataFrame:
    """Text rows -> rows with date and duration; empty texts become null, notes stay text."""
    start, end = log_timestamp(F.col("start_time")), log_timestamp(F.col("end_time"))
    return rows.select(
        "user_id",
        start.cast("date").alias("date"),
        "pos",
        "title",
        duration_text(minutes_between(start, end)).alias("duration"),
        F.col("exercise_title").alias("exercise"),
        "set_type",
        *(blank_to_null(F.col(c)).alias(c) for c in ("weight_lbs", "reps", "distance_miles", "duration_seconds", "rpe")),
        F.coalesce("exercise_notes", F.lit("")).alias("notes"),
        "source",
    )


def unreadable_log_rows(rows: DataFrame) -> DataFrame:
    """Quarantine: rows whose start or end time cannot be read."""
    return rows.filter(log_timestamp(F.col("start_time")).isNull() | log_timestamp(F.col("end_time")).isNull())


def first_sessions(log: DataFrame) -> DataFrame:
    """One workout per user and day: title and duration of the first row of the export that landed first.

    One scan and one partial aggregate ordered by (source, position) choose the export and its first row at once.
    """
    order, row = F.struct("source", "pos"), F.struct("title", "duration")
    best = log.groupBy(*DAY).agg(F.min_by(row, order).alias("_row"), F.min(order).alias("_first"))
    return best.select(*DAY, "_row.*", F.col("_first.pos").alias("seq"), F.col("_first.source").alias("source"))


def split_log(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Readable log rows -> one workout per user and day, and its sets in log order.

    Each export holds the whole history, so exports overlap: a day is taken from the one that landed first. The sets are the
    rows whose export is that of their workout.
    """
    dated = log.filter(F.col("date").isNotNull())
    sessions = first_sessions(dated)
    sets = dated.join(sessions.select(*DAY, "source"), [*DAY, "source"], "left_semi")
    return sessions, sets.drop("title", "duration")


def legacy_log(rows: DataFrame) -> DataFrame:
    """First-version rows: title of the first row, no duration, empty numbers read as null."""
    return rows.filter(F.col("date").isNotNull()).select(
        *DAY,
        "pos",
        "title",
        F.lit("0:00").alias("duration"),
        "exercise",
        "set_type",
        *(blank_to_null(F.col(c)).alias(c) for c in ("weight_lbs", "reps", "distance_miles", "duration_seconds", "rpe")),
        F.coalesce("notes", F.lit("")).alias("notes"),
        "source",
    )
