"""The nested coach payload: last night, body weight, the week so far and recent workouts."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import low_sleep
from ..functions.dates import between_days
from ..functions.numbers import truthy_or
from ..schemas import DAY, SUMMARY
from .ranking import top_rows
from .workouts import collect_parts, exercise_groups, reduce_sets, summaries, training_days, workout_notes

RECENT = 3
#: Summaries of a user that the stored state holds; it answers for so many recent workouts.
KEPT = 8


def prior_day(daily: DataFrame, day: datetime.date, every_user: bool = False) -> DataFrame:
    """Per user: sleep and heart rate of the day before, body weight of that day or of ``day``.

    One aggregate over two days instead of a self join. With ``every_user`` it also lists users without
    either day.
    """
    before = day - datetime.timedelta(days=1)
    is_before, is_day = F.col("date") == F.lit(before), F.col("date") == F.lit(day)
    rows = between_days(daily, before, day)

    def pick(name: str, when):
        return F.max(F.when(when, F.col(name)))

    found = rows.groupBy("user_id").agg(
        pick("sleep_hours", is_before).alias("hours"),
        pick("sleep_score", is_before).alias("score"),
        pick("resting_heart_rate", is_before).alias("resting_hr"),
        truthy_or(pick("bodyweight", is_before), pick("bodyweight", is_day)).alias("bodyweight"),
    )
    # The users are read from one narrow column; the days from the folders of two.
    return daily.select("user_id").distinct().join(found, "user_id", "left") if every_user else found


def recent_summaries(
    sets: DataFrame,
    n: int = 5,
    newest: bool = True,
    until: datetime.date | None = None,
    sets_of: Callable[[DataFrame], DataFrame] | None = None,
    **classes,
) -> DataFrame:
    """Summaries of the last (or first) ``n`` training days of each user with their ``recency``.

    Only sets of the chosen days go on. ``sets_of`` gives the sets of a table of days (user_id, date): where sets
    are made by joins, it can choose before them, and all other sets need not be made a second time.
    """
    days = training_days(sets, n, newest, until)
    key = ["user_id", "date"]
    chosen_days = days.select(*key)
    kept = sets.join(chosen_days, key, "left_semi") if sets_of is None else sets_of(chosen_days)
    chosen = collect_parts(reduce_sets(kept))
    noted = kept.filter(F.col("notes") != "")
    return summaries(chosen, workout_notes(noted, chosen), **classes).join(days, key)


def day_summaries(sets: DataFrame, **classes) -> DataFrame:
    """The summary of every day with sets, to be stored by day: later runs rank these small rows."""
    groups = exercise_groups(sets)
    return summaries(groups, workout_notes(sets, groups), **classes)


def recent_of(stored: DataFrame, n: int = 5, newest: bool = True, until: datetime.date | None = None) -> DataFrame:
    """The last (or first) ``n`` stored summaries of each user with their ``recency``."""
    rows = stored if until is None else stored.filter(F.col("date") <= F.lit(until))
    order = F.desc("date") if newest else F.asc("date")
    return top_rows(rows, ["user_id"], [order], n, "recency").select(*DAY, "summary", "recency")


def newest_state(stored: DataFrame, changed: DataFrame, months: Sequence[str] | None, keep: int = KEPT) -> tuple[DataFrame, DataFrame]:
    """The newest ``keep`` summaries of each user after the ``months`` of ``changed`` were replaced, and the users for whom
    the stored state cannot tell.

    A state of ``keep`` rows knows every day from its oldest one on; a shorter one knows all days. A user who lost days so
    that fewer than ``keep`` known ones are left has to be read from the summaries.
    """
    if months is None:
        return newest_summaries(changed, keep), stored.select("user_id").limit(0)
    own = Window.partitionBy("user_id")
    known = stored.withColumn("known_from", F.when(F.count(F.lit(1)).over(own) >= keep, F.min("date").over(own)))
    left = known.filter(~F.date_format("date", "yyyy-MM").isin(*months))
    edge = known.groupBy("user_id").agg(F.min("known_from").alias("known_from"))
    fresh = changed.select(*DAY, "summary").join(edge, "user_id", "left")
    rows = left.unionByName(fresh).filter(F.col("known_from").isNull() | (F.col("date") >= F.col("known_from")))
    counts = rows.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    short = edge.filter(F.col("known_from").isNotNull()).join(counts, "user_id", "left").filter(F.coalesce("n", F.lit(0)) < keep)
    return newest_summaries(rows, keep), short.select("user_id")


def newest_summaries(rows: DataFrame, keep: int = KEPT) -> DataFrame:
    """The newest ``keep`` summaries of each user."""
    return top_rows(rows.select(*DAY, "summary"), ["user_id"], [F.desc("date")], keep, "place").drop("place")


def coach_payload(
    prior: DataFrame,
    week: DataFrame,
    recent: DataFrame,
    day: datetime.date,
    n: int = RECENT,
) -> DataFrame:
    """One payload row per user of ``prior``, assembled from parts already grouped by user."""
    pairs = F.array_sort(F.collect_list(F.struct("muscle", "sets")))
    volume = week.groupBy("user_id").agg(F.map_from_entries(pairs).alias("week_volume"))
    places = [F.first(F.when(F.col("recency") == i, F.col("summary")), ignorenulls=True) for i in range(1, n + 1)]
    workouts = recent.groupBy("user_id").agg(F.array_compact(F.array(*places)).alias("workouts"))
    no_volume = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    no_workout = F.from_json(F.lit('{"had_workout": false}'), SUMMARY)
    summary_list = F.coalesce("workouts", F.array().cast(f"array<{SUMMARY}>"))
    return (
        prior.join(volume, "user_id", "left")
        .join(workouts, "user_id", "left")
        .select(
            "user_id",
            F.lit(day.isoformat()).alias("date_for_plan"),
            F.struct("hours", "score", "resting_hr").alias("sleep_last_night"),
            "bodyweight",
            F.coalesce("week_volume", no_volume).alias("week_volume"),
            summary_list.alias("recent_workouts"),
            F.coalesce(F.get(summary_list, F.lit(0)), no_workout).alias("last_workout_summary"),
            low_sleep(F.col("hours")).alias("low_sleep_flag"),
        )
    )


def payload_json(payload: DataFrame) -> DataFrame:
    """Payload as one JSON text per user. Null biometrics stay in the text, as in the document;
    absent fields of a missing workout do not."""
    fields = [c for c in payload.columns if c != "user_id"]
    last = F.col("last_workout_summary")
    document = F.struct(*(F.col(c) for c in fields))
    full = F.to_json(document, {"ignoreNullFields": "false"})
    bare = F.to_json(document.withField("last_workout_summary", F.struct(F.lit(False).alias("had_workout"))),
                     {"ignoreNullFields": "false"})
    return payload.select("user_id", F.when(last.getField("had_workout"), full).otherwise(bare).alias("payload"))
