"""The central table: one row per user and day from wearable metrics and workouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import NO_DURATION, milliseconds_to_hours
from ..functions.effort import DEFAULT_USER_LBS, WeightWords, effective_weight, set_calories
from ..functions.numbers import blank_to_null, cast_or, exact_sum, truncate, zero_to_null
from ..schemas import DAY
from .dims import attach_dim
from .latest import first_row, pivot_latest

# Accepted spellings of the series names, the qualified one first.
DAILY_METRICS = {
    "steps": ("steps_activities-steps", "steps"),
    "distance": ("distance_activities-distance", "distance"),
    "calories_out": ("calories_out_activities-calories", "calories_out"),
    "sleep_duration": ("sleep_duration",),
    "sleep_efficiency": ("sleep_efficiency",),
    "heart": ("heart_activities-heart", "heart"),
    "weight": ("weight_body-weight", "weight"),
}
HEART_SPELLINGS = DAILY_METRICS["heart"]
# Metrics whose text must read as a whole number; the others may carry decimals.
WHOLE_METRICS = ("steps", "calories_out", "sleep_efficiency", "heart")
WHOLE_SPELLINGS = [s for m in WHOLE_METRICS for s in DAILY_METRICS[m]]
KNOWN_SPELLINGS = [s for names in DAILY_METRICS.values() for s in names]


def _number_text() -> Column:
    heart = F.get_json_object("value", "$.restingHeartRate")
    return F.when(F.col("metric").isin(*HEART_SPELLINGS), heart).otherwise(F.col("value"))


def _number(text: Column) -> Column:
    whole = text.try_cast("bigint").cast("double")
    return F.when(F.col("metric").isin(*WHOLE_SPELLINGS), whole).otherwise(text.try_cast("double"))


def typed_series(series: DataFrame) -> DataFrame:
    """Text series -> numeric series of the metrics a day is built from; unreadable text is null."""
    return series.filter(F.col("metric").isin(*KNOWN_SPELLINGS)).withColumn("value", _number(_number_text()))


def unreadable_values(series: DataFrame) -> DataFrame:
    """Quarantine: known metrics whose text is present but is no number of the metric's type."""
    text = _number_text()
    known = series.filter(F.col("metric").isin(*KNOWN_SPELLINGS))
    return known.filter(blank_to_null(text).isNotNull() & _number(text).isNull())


def wearable_days(series: DataFrame, missing_as_null: bool = False) -> DataFrame:
    """Numeric long series -> one canonical row per user and day. Absent metrics take their default,
    or stay null as in the first version of the table."""

    def filled(column: Column, default) -> Column:
        return column if missing_as_null else F.coalesce(column, F.lit(default))

    wide = pivot_latest(series, DAILY_METRICS)
    return wide.select(
        *DAY,
        filled(F.col("steps").cast("bigint"), 0).alias("steps"),
        filled(F.col("distance"), 0.0).alias("distance"),
        filled(F.col("calories_out").cast("bigint"), 0).alias("calories_burned_from_steps"),
        milliseconds_to_hours(filled(F.col("sleep_duration"), 0.0)).alias("sleep_hours"),
        F.col("sleep_efficiency").cast("int").alias("sleep_score"),
        filled(F.col("heart").cast("int"), 0).alias("resting_heart_rate"),
        filled(F.col("weight"), 0.0).alias("bodyweight"),
    )


def typed_sets(sets: DataFrame) -> DataFrame:
    """Text set columns -> numbers; empty and unreadable weight, reps and seconds become 0."""
    columns = {
        "weight_lbs": cast_or(F.col("weight_lbs"), "double", 0.0),
        "reps": cast_or(F.col("reps"), "int", 0),
        "duration_seconds": cast_or(F.col("duration_seconds"), "int", 0),
        "distance_miles": F.col("distance_miles").try_cast("double"),
        "exercise": F.coalesce("exercise", F.lit("")),
    }
    return sets.withColumns({name: c for name, c in columns.items() if name in sets.columns})


def unreadable_sets(sets: DataFrame) -> DataFrame:
    """Quarantine: set rows with a weight, reps or seconds text that is no number."""

    def bad(name: str, type_name: str) -> Column:
        return blank_to_null(F.col(name)).isNotNull() & F.col(name).try_cast(type_name).isNull()

    return sets.filter(bad("weight_lbs", "double") | bad("reps", "int") | bad("duration_seconds", "int"))


def plain_sets(
    sets: DataFrame, user_lbs: Column | float = DEFAULT_USER_LBS, words: WeightWords = WeightWords()
) -> DataFrame:
    """Typed sets with their effective weight, before any lookup: what the figures of a workout need."""
    pounds = user_lbs if isinstance(user_lbs, Column) else F.lit(float(user_lbs))
    order = [c for c in ("pos", "tie") if c in sets.columns]
    return sets.select(
        *DAY,
        *order,
        "exercise",
        effective_weight(F.col("weight_lbs"), F.col("exercise"), F.col("notes"), pounds, words).alias("weight_lbs"),
        zero_to_null(F.col("reps")).alias("reps"),
        F.coalesce("notes", F.lit("")).alias("notes"),
    )


def canonical_sets(
    sets: DataFrame,
    dim: DataFrame,
    user_lbs: Column | float = DEFAULT_USER_LBS,
    words: WeightWords = WeightWords(),
) -> DataFrame:
    """Typed sets with muscles, effective weight and energy; zero reps and distance become null.

    ``user_lbs`` is a constant or a column of ``sets``, so each user may have a body weight.
    """
    pounds = user_lbs if isinstance(user_lbs, Column) else F.lit(float(user_lbs))
    weight, reps = F.col("weight_lbs"), F.col("reps")
    order = [c for c in ("pos", "tie") if c in sets.columns]
    return attach_dim(sets, dim).select(
        *DAY,
        *order,
        "exercise",
        "set_type",
        effective_weight(weight, F.col("exercise"), F.col("notes"), pounds, words).alias("weight_lbs"),
        weight.alias("raw_weight_lbs"),
        zero_to_null(reps).alias("reps"),
        zero_to_null(F.col("distance_miles")).alias("distance"),
        F.coalesce("notes", F.lit("")).alias("notes"),
        "muscle_groups",
        set_calories(F.col("met"), reps, F.col("duration_seconds"), pounds).alias("calories"),
    )


def day_calories(sets: DataFrame) -> DataFrame:
    """Energy of a day's sets, summed exactly and cut to a whole number."""
    total = truncate(exact_sum(F.col("calories")))
    return sets.groupBy(*DAY).agg(total.alias("calories_burned_from_workout"))


def workouts_of_sets(log: DataFrame) -> DataFrame:
    """One workout per user and day from set rows of one source: title and duration of the first row."""
    return first_row(log.select(*DAY, "title", "duration", F.col("pos").alias("seq"), "source"), DAY, "seq")


def last_workout_wins(workouts: DataFrame) -> DataFrame:
    """Of several workout records of one day the last one stays."""
    best = F.max_by(F.struct("title", "duration"), "seq").alias("_row")
    return workouts.groupBy(*DAY).agg(best, F.max("seq").alias("seq")).select(*DAY, "_row.*", "seq")


def combine_days(
    wearable: DataFrame, workouts: DataFrame, calories: DataFrame, missing_as_null: bool = False
) -> DataFrame:
    """Full outer merge on user and day. All three sides are already grouped by that key, so the
    joins reuse the partitioning of the aggregates."""

    def filled(name: str, default) -> Column:
        return F.col(name) if missing_as_null else F.coalesce(F.col(name), F.lit(default))

    trained = workouts.select(*DAY, "title", "duration").join(calories, DAY, "left")
    both = wearable.join(trained, DAY, "full_outer")
    from_steps = F.coalesce("calories_burned_from_steps", F.lit(0))
    from_workout = F.coalesce("calories_burned_from_workout", F.lit(0))
    return both.select(
        *DAY,
        filled("steps", 0).alias("steps"),
        filled("distance", 0.0).alias("distance"),
        (from_steps + from_workout).alias("total_calories_burned"),
        filled("sleep_hours", 0.0).alias("sleep_hours"),
        "sleep_score",
        F.col("title").alias("workout_title"),
        F.coalesce("duration", F.lit(NO_DURATION)).alias("total_workout_duration"),
        from_workout.alias("calories_burned_from_workout"),
        from_steps.alias("calories_burned_from_steps"),
        filled("resting_heart_rate", 0).alias("resting_heart_rate"),
        filled("bodyweight", 0.0).alias("bodyweight"),
    )
