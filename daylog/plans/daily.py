"""Jobs on the stored tables: combine, averages, payload, feed and dashboard."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.effort import DEFAULT_USER_LBS, WeightWords
from ..operators.coach import (
    KEPT,
    RECENT,
    coach_payload,
    day_summaries,
    newest_state,
    payload_json,
    prior_day,
    recent_of,
    recent_summaries,
)
from ..operators.days import (
    canonical_sets,
    combine_days,
    day_calories,
    typed_series,
    typed_sets,
    unreadable_sets,
    unreadable_values,
    wearable_days,
)
from ..operators.dims import checked_broadcast, exercise_dim, unmapped_exercises
from ..operators.feed import between_days, metric_feed, missing_days, on_day
from ..operators.month_parts import MONTH_PARTS, averages_of, merged, month_parts, user_means_of
from ..operators.trends import ROLLING_ROWS, averages_lines, dashboard_days, rolling_means, set_totals, with_user_means
from ..operators.weeks import progress_of, ranked_of, week_figures, week_volume, weekly_sets_trailing
from ..operators.workouts import workout_text
from ..schemas import AVERAGES, DAILY, DASHBOARD, DAY, FEED, SERIES, SETS, SUMMARIES, WEEKS, WORKOUTS
from ..sources.snapshots import begin, newest
from ..sources.store import (
    MONTH,
    ONE_DAY,
    WHOLE,
    manifest,
    read_flat,
    read_table,
    replace_range,
    write_flat,
    write_json,
    write_partitions,
)
from .paths import Store

TRAINING_SETS = (
    "user_id bigint, date date, pos bigint, exercise string, set_type string, weight_lbs double, "
    "raw_weight_lbs double, reps int, distance double, notes string, muscle_groups array<string>, calories double"
)


@dataclass(frozen=True)
class Combined:
    """The central table and the sets behind it."""

    daily: DataFrame
    sets: DataFrame
    #: The sets of a table of days, where they can be had for less than a join of ``sets``.
    sets_of: Callable[[DataFrame], DataFrame] | None = None


def combine(
    series: DataFrame,
    workouts: DataFrame,
    sets: DataFrame,
    dim: DataFrame,
    user_lbs: Column | float = DEFAULT_USER_LBS,
    words: WeightWords = WeightWords(),
) -> Combined:
    """Numeric series, workouts and typed sets -> one row per user and day, and canonical sets."""
    canonical = canonical_sets(sets, dim, user_lbs, words)
    return Combined(combine_days(wearable_days(series), workouts, day_calories(canonical)), canonical)


def run_combine(
    spark: SparkSession,
    store: Store,
    dim: DataFrame | None = None,
    user_lbs: float = DEFAULT_USER_LBS,
    months: Sequence[str] | None = None,
) -> None:
    """Stored series, workouts and sets -> stored daily table and training sets.

    Days are independent, so a run may take only the ``months`` (``yyyy-MM``) its ingest touched.
    """
    series = typed_series(_stored_series(spark, store, months))
    workouts = read_table(spark, store.workouts, WORKOUTS, MONTH, months).drop(MONTH)
    sets = typed_sets(read_table(spark, store.sets, SETS, MONTH, months).drop(MONTH))
    dim = checked_broadcast(dim if dim is not None else exercise_dim(spark))
    combined = combine(series, workouts, sets, dim, user_lbs)
    replaced = months  # without months, stored ones that have no input any more are emptied
    write_partitions(combined.sets, store.training_sets, ["user_id", "date", "pos"], MONTH, replaced)
    # The energy of a day is summed from the sets just stored, not worked out a second time.
    training = read_table(spark, store.training_sets, TRAINING_SETS, MONTH, months)
    days = combine_days(wearable_days(series), workouts, day_calories(training))
    write_partitions(days, store.daily, DAY, MONTH, replaced)
    write_partitions(day_summaries(training), store.summaries, DAY, MONTH, replaced)
    write_recent(spark, store, months)


def write_recent(spark: SparkSession, store: Store, months: Sequence[str] | None = None) -> None:
    """Bring each user's newest summaries up to date with the ``months`` that were replaced (None: all).

    Only these months are read, but for users who lost so many days that older ones move up; months before are read for
    them alone.
    """
    if not newest(spark, store.recent).partitions:
        months = None
    base = begin(spark, store.recent)
    stored = read_table(spark, store.recent, SUMMARIES, WHOLE, snapshot=base).drop(WHOLE)
    changed = read_table(spark, store.summaries, SUMMARIES, MONTH, months).drop(MONTH)
    rows, short = newest_state(stored, changed, months)
    if months is not None and not short.isEmpty():
        everything = read_table(spark, store.summaries, SUMMARIES).drop(MONTH)
        again, _ = newest_state(stored, everything.join(short, "user_id", "left_semi"), None)
        rows = rows.join(short, "user_id", "left_anti").unionByName(again)
    write_partitions(rows, store.recent, DAY, WHOLE, None, base)


def _stored_series(spark: SparkSession, store: Store, months: Sequence[str] | None) -> DataFrame:
    """The stored series of all days, or of some months."""
    rows = read_table(spark, store.series, SERIES, ONE_DAY)
    kept = rows if months is None else rows.filter(F.substring(ONE_DAY, 1, 7).isin(*months))
    return kept.drop(ONE_DAY)


def run_checks(spark: SparkSession, store: Store, dim: DataFrame | None = None) -> None:
    """Data-quality tables: values and sets that do not read as numbers, exercises without muscles."""
    dim = checked_broadcast(dim if dim is not None else exercise_dim(spark))
    series = _stored_series(spark, store, None)
    sets = read_table(spark, store.sets, SETS).drop(MONTH)
    write_flat(unreadable_values(series), f"{store.bad_rows}/series")
    write_flat(unreadable_sets(sets), f"{store.bad_rows}/sets")
    write_flat(unmapped_exercises(typed_sets(sets), dim), f"{store.bad_rows}/exercises")


def load_combined(spark: SparkSession, store: Store) -> Combined:
    """The stored tables with their ``month``, by which date ranges prune folders."""
    return Combined(read_table(spark, store.daily, DAILY), read_table(spark, store.training_sets, TRAINING_SETS))


def write_month_parts(spark: SparkSession, store: Store, months: Sequence[str] | None = None) -> DataFrame:
    """Replace the stored parts of the ``months`` (None: all) and return every user's parts merged."""
    daily = read_table(spark, store.daily, DAILY, MONTH, months).drop(MONTH)
    write_partitions(month_parts(daily), store.month_parts, DAY, MONTH, months)
    return merged(read_table(spark, store.month_parts, MONTH_PARTS).drop(MONTH))


def run_averages(spark: SparkSession, store: Store, months: Sequence[str] | None = None) -> None:
    """Store the averages as a table, as JSON and as the published lines, and the overall means of the dashboard.

    Days are read of the ``months`` that changed alone (None: all); other months come from their stored sums and counts.
    """
    users = write_month_parts(spark, store, months)
    write_flat(averages_of(users), store.averages)
    write_flat(user_means_of(users), store.user_means)
    means = load_averages(spark, store)
    write_json(means, f"{store.documents}/averages", ["user_id"])
    write_flat(averages_lines(means), f"{store.documents}/averages_text")


def load_averages(spark: SparkSession, store: Store) -> DataFrame:
    return read_flat(spark, store.averages, AVERAGES)


def build_payload(
    combined: Combined,
    day: datetime.date,
    n: int = RECENT,
    until: datetime.date | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Coach payload of every user with a day on record. With ``stored`` summaries the sets are read for
    the week only; these may be each user's newest ones alone."""
    prior = prior_day(combined.daily, day, every_user=True)
    recent = recent_summaries(combined.sets, n, until=until, sets_of=combined.sets_of) if stored is None else recent_of(stored, n, until=until)
    return coach_payload(prior, week_volume(combined.sets, day), recent, day, n)


def run_payload(
    spark: SparkSession, store: Store, day: datetime.date, n: int = RECENT, until: datetime.date | None = None
) -> None:
    """Store the payload of a day, as a table and as one JSON document per user. Recent workouts are
    those up to ``until`` where it is given: then, or for many workouts, all summaries are ranked; else the stored
    newest ones of each user are enough."""
    if until is None and n <= KEPT and newest(spark, store.recent).partitions:
        stored = read_table(spark, store.recent, SUMMARIES, WHOLE).drop(WHOLE)
    else:
        stored = read_table(spark, store.summaries, SUMMARIES).drop(MONTH)
    write_flat(build_payload(load_combined(spark, store), day, n, until, stored), store.payload)
    payload = read_flat(spark, store.payload)
    write_json(payload_json(payload), f"{store.documents}/payload", ["user_id"])


def feed_of_day(combined: Combined, day: datetime.date) -> DataFrame:
    """Feed rows of one day."""
    return metric_feed(on_day(combined.daily, day), workout_text(on_day(combined.sets, day)))


def feed_of_range(combined: Combined, first: datetime.date, last: datetime.date) -> DataFrame:
    """Feed rows of every recorded day of the range."""
    days = between_days(combined.daily, first, last)
    return metric_feed(days, workout_text(between_days(combined.sets, first, last)))


def feed_of_all(combined: Combined) -> DataFrame:
    return metric_feed(combined.daily, workout_text(combined.sets))


def run_feed(spark: SparkSession, store: Store, first: datetime.date, last: datetime.date) -> None:
    """Store the feed of a range of days; stored days outside it stay. Days without a record are listed too."""
    combined = load_combined(spark, store)
    replace_range(feed_of_range(combined, first, last), store.feed, FEED, first, last, ["user_id", "date", "metric_type"])
    write_flat(missing_days(combined.daily, first, last), store.missing_days)


def run_feed_months(spark: SparkSession, store: Store, months: Sequence[str]) -> None:
    """Store the feed of whole months; other stored months stay."""
    daily = read_table(spark, store.daily, DAILY, MONTH, months).drop(MONTH)
    sets = read_table(spark, store.training_sets, TRAINING_SETS, MONTH, months).drop(MONTH)
    write_partitions(feed_of_all(Combined(daily, sets)), store.feed, ["user_id", "date", "metric_type"], MONTH, months)


def dashboard(combined: Combined, dim: DataFrame) -> DataFrame:
    """Dashboard rows with rolling and overall means."""
    days = dashboard_days(combined.daily, set_totals(combined.sets, dim))
    return with_user_means(rolling_means(days))


def dashboard_months(days: DataFrame, months: Sequence[str]) -> tuple[list[str], list[str]]:
    """Months whose rolling means depend on ``months``, and the months that have to be read for them.

    Decided on user and day alone. A row depends on the rows of its window, so a change reaches six rows on, in whatever
    month they lie, and each of those needs the six rows before it.
    """
    month = F.date_format("date", "yyyy-MM")
    own = Window.partitionBy("user_id").orderBy("date")
    before, after = own.rowsBetween(1 - ROLLING_ROWS, 0), own.rowsBetween(0, ROLLING_ROWS - 1)
    rows = days.select(*DAY, month.alias("m"))

    def found(marked: DataFrame) -> list[str]:
        return sorted(r.m for r in marked.filter("hit").select("m").distinct().collect())  # bounded by the calendar

    stale = found(rows.withColumn("hit", F.max(F.col("m").isin(*months)).over(before)))
    if not stale:
        return [], []
    return stale, found(rows.withColumn("hit", F.max(F.col("m").isin(*stale)).over(after)))


def run_dashboard(spark: SparkSession, store: Store, dim: DataFrame | None = None, months: Sequence[str] | None = None) -> None:
    """Store the dashboard's days with rolling means, with the intensities of the dashboard's own table (version 2).

    With ``months`` only rows that depend on them are made anew. Overall means of a user change with every day, so they
    are stored by user (``run_averages``) and joined by ``load_dashboard``.
    """
    dim = checked_broadcast(dim if dim is not None else exercise_dim(spark, 2))
    stale = needed = None
    if months is not None:
        emptied = sorted(set(months) & set(manifest(spark, store.dashboard)))
        stale, needed = dashboard_months(read_table(spark, store.daily, DAILY).drop(MONTH), months)
        stale = sorted({*stale, *emptied})
    daily = read_table(spark, store.daily, DAILY, MONTH, needed).drop(MONTH)
    sets = read_table(spark, store.training_sets, TRAINING_SETS, MONTH, needed).drop(MONTH)
    rows = rolling_means(dashboard_days(daily, set_totals(sets, dim)))
    if stale is not None:
        rows = rows.filter(F.date_format("date", "yyyy-MM").isin(*stale))
    write_partitions(rows, store.dashboard, replaced=stale)


def load_dashboard(spark: SparkSession, store: Store) -> DataFrame:
    """The stored dashboard with each user's overall means."""
    means = read_flat(spark, store.user_means)
    rows = read_table(spark, store.dashboard, DASHBOARD).drop(MONTH)
    return rows.join(means, "user_id", "left")


def weeks_of(months: Sequence[str]) -> list[datetime.date]:
    """The Mondays of all weeks that have a day in one of the months."""
    found = set()
    for month in months:
        day = datetime.date.fromisoformat(f"{month}-01")
        while day.isoformat()[:7] == month:
            found.add(day - datetime.timedelta(days=day.weekday()))
            day += datetime.timedelta(days=1)
    return sorted(found)


def write_weeks(spark: SparkSession, store: Store, months: Sequence[str] | None = None) -> list[str]:
    """Bring the stored weeks up to date with the ``months`` that changed (None: all); returns the weeks written.

    Weeks that straddle months are partitions like others, made from the days of both. Of the weeks that may have changed
    only those whose figures differ from the stored ones are written.
    """
    mondays = None if months is None else weeks_of(months)
    base = begin(spark, store.weeks)
    needed = None if mondays is None else sorted({(d + datetime.timedelta(days=k)).isoformat()[:7] for d in mondays for k in (0, 6)})
    sets = read_table(spark, store.training_sets, TRAINING_SETS, MONTH, needed).drop(MONTH)
    fresh = week_figures(sets).withColumnRenamed("week", "date").select(*(x.split()[0] for x in WEEKS.split(", ")))
    if mondays is not None:
        fresh = fresh.filter(F.col("date").isin(*mondays))
    stored = read_table(spark, store.weeks, WEEKS, ONE_DAY, None if mondays is None else [d.isoformat() for d in mondays], base).drop(ONE_DAY)
    both = fresh.withColumn("side", F.lit(1)).unionByName(stored.withColumn("side", F.lit(-1)))
    differing = both.groupBy(*stored.columns).agg(F.sum("side").alias("side")).filter("side <> 0")
    weeks = sorted(r.date.isoformat() for r in differing.select("date").distinct().collect())  # bounded by the calendar
    if weeks:
        rows = fresh.filter(F.date_format("date", "yyyy-MM-dd").isin(*weeks))
        write_partitions(rows, store.weeks, ["user_id", "muscle"], ONE_DAY, weeks, base)
    return weeks


def run_weekly(spark: SparkSession, store: Store, months: Sequence[str] | None = None) -> list[str]:
    """Store the weekly tables: all weeks, the trailing days, ranked weights, and tracked muscles.

    The views come from the stored weeks, for which sets are read of the weeks that the ``months`` touch (None: all). The
    trailing days begin at each user's own last day, so they are taken from all sets.
    """
    weeks = write_weeks(spark, store, months)
    weekly = read_table(spark, store.weeks, WEEKS, ONE_DAY).drop(ONE_DAY).withColumnRenamed("date", "week")
    write_flat(weekly.select("user_id", "week", "muscle", "sets"), f"{store.weekly}/sets")
    write_flat(weekly_sets_trailing(load_combined(spark, store).sets), f"{store.weekly}/sets_trailing")
    write_flat(ranked_of(weekly), f"{store.weekly}/weight_ranked")
    write_flat(progress_of(weekly), f"{store.weekly}/progress")
    return weeks
