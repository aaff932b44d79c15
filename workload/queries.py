"""One query per operator, over the whole test tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.functions.classify import low_sleep, steps_colour
from daylog.functions.dates import (
    duration_minutes,
    duration_text,
    hours_minutes_text,
    iso_date,
    iso_week,
    iso_year,
    short_number,
    sleep_text,
    week_start,
)
from daylog.functions.effort import is_weighted, km_to_miles, pounds_to_kg
from daylog.functions.numbers import fixed, float_text, round_exact, round_whole, thousands
from daylog.functions.text import fill_template
from daylog.operators import coach, days, dims, feed, trends, weeks, workouts
from daylog.operators.coach import newest_state, newest_summaries
from daylog.operators.latest import last_write_wins, pivot_latest
from daylog.operators.month_parts import averages_of, merged, month_parts, reference_lines_of, valid_ranges_of
from daylog.plans import daily as jobs
from daylog.plans import rendering
from daylog.schemas import COMBINED_SET, DAY
from daylog.sources.readers import combined_sets
from daylog.sources.setlog import legacy_log, parse_set_log, split_log
from daylog.sources.store import load_audit, new_wins, preview, stored_wins, union_rows
from daylog.sources.wearable import basic_series, flatten_documents
from daylog.streaming.jobs import weekly_totals

from . import bindings as b

FEED_FROM, FEED_TO = datetime.date(2023, 12, 25), datetime.date(2024, 1, 20)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def six(name: str, source: str | None = None) -> Column:
    return round_exact(F.col(source or name), 6).alias(name)


# --- ingest -----------------------------------------------------------------------------


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a landed wearable document: members, bare lists, nested series and sleep."""
    date = F.date_format("ts", "yyyy-MM-dd")
    whole = F.col("value").cast("bigint").cast("string")
    point = F.array(F.struct(date.alias("dateTime"), whole.alias("value")))
    kind = F.col("event_type")

    def member(api: str) -> Column:
        return F.to_json(F.struct(point.alias(api)))

    nested = F.to_json(
        F.struct(
            F.struct(point.alias("activities-minutesVeryActive")).alias("very"),
            F.struct(point.alias("activities-minutesLightlyActive")).alias("light"),
        )
    )
    body = (
        F.when(kind == "view", F.create_map(F.lit("steps"), member("activities-steps")))
        .when(kind == "click", F.create_map(F.lit("distance"), F.to_json(point)))
        .when(kind == "purchase", F.create_map(F.lit("calories_out"), member("activities-calories")))
        .when(kind == "error", F.create_map(F.lit("active_minutes"), nested))
    )
    k = F.get_json_object("props", "$.k")
    night = F.struct(
        F.when(k != "0", date).otherwise(F.lit("")).alias("dateOfSleep"),
        whole.alias("duration"),
        k.alias("efficiency"),
        F.concat(date, F.lit("T23:00:00")).alias("startTime"),
        F.lit(None).cast("string").alias("endTime"),
    )
    sleep = F.when(kind == "signup", F.array(night))
    return b.table(spark, sf_dir, "events").select(
        "user_id", "event_id", body.alias("time_series"), sleep.alias("sleep")
    )


@query
def flatten_series(spark, sf):
    documents = event_documents(spark, sf)
    return flatten_documents(documents, order="event_id", whole_days=False).drop("seq", "source")


@query
def flatten_legacy_series(spark, sf):
    documents = event_documents(spark, sf)
    return flatten_documents(documents, order="event_id", qualified=True).drop("seq", "source")


@query
def basic_series_only(spark, sf):
    documents = event_documents(spark, sf)
    series = flatten_documents(documents, order="event_id", qualified=True, whole_days=False)
    return basic_series(series).drop("seq", "source")


@query
def typed_day_from_documents(spark, sf):
    series = flatten_documents(event_documents(spark, sf), order="event_id", whole_days=False)
    wide = days.wearable_days(days.typed_series(series))
    return wide.select(*DAY, "steps", "distance", "calories_burned_from_steps", six("sleep_hours"), "sleep_score")


@query
def unreadable_series(spark, sf):
    """Step counts sent with decimals are no whole numbers: they go to quarantine."""
    events = b.table(spark, sf, "events")
    rows = events.select(
        "user_id",
        F.col("ts").cast("date").alias("date"),
        F.when(F.col("event_type") == "view", "steps").otherwise("distance").alias("metric"),
        fixed(F.col("value"), 2).alias("value"),
        F.col("event_id").alias("seq"),
    )
    return days.unreadable_values(rows)


@query
def daily_pivot(spark, sf):
    return pivot_latest(b.series(spark, sf), {m: (m,) for m in days.DAILY_METRICS})


@query
def sleep_last_wins(spark, sf):
    night = b.series(spark, sf).filter(F.col("metric").startswith("sleep_"))
    return last_write_wins(night, [*DAY, "metric"])


@query
def upsert_new_wins(spark, sf):
    series = b.series(spark, sf)
    heart = F.col("metric") == "heart"
    return new_wins(series.filter(~heart), series.filter(heart))


@query
def insert_if_absent(spark, sf):
    orders = b.workout_rows(spark, sf)
    titled = F.col("title").isin("1-URGENT", "2-HIGH")
    stored = days.last_workout_wins(orders.filter(titled))
    return stored_wins(stored, days.last_workout_wins(orders.filter(~titled)))


@query
def series_union(spark, sf):
    series = b.series(spark, sf)
    both = union_rows(*(series.filter(F.col("metric") == metric) for metric in days.DAILY_METRICS))
    return both.groupBy(*DAY).agg(F.count("*").alias("n_rows"), F.countDistinct("metric").alias("n_metrics"))


@query
def set_log_parsed(spark, sf):
    """Set-log texts as exported, parsed back: time, duration, empty fields."""

    def every(n: int, name: str) -> Column:
        """The last digits of the key as text, empty on each n-th row."""
        text = (F.col("o_orderkey") % 100).cast("string")
        return F.when(F.col("o_orderkey") % n == 0, "").otherwise(text).alias(name)

    start = F.col("o_orderdate") + F.expr("make_dt_interval(0, 0, o_orderkey % 1440, 0)")
    end = start + F.expr("make_dt_interval(0, 0, CAST(o_totalprice AS BIGINT) % 200, 0)")
    pattern = "d MMM yyyy, H:mm"
    rows = b.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("pos"),
        F.col("o_orderpriority").alias("title"),
        F.date_format(start, pattern).alias("start_time"),
        F.date_format(end, pattern).alias("end_time"),
        F.col("o_orderstatus").alias("exercise_title"),
        F.lit("normal").alias("set_type"),
        F.when(F.col("o_orderstatus") == "F", "").otherwise(F.col("o_orderkey").cast("string")).alias("weight_lbs"),
        every(5, "reps"),
        every(3, "distance_miles"),
        every(7, "duration_seconds"),
        every(2, "rpe"),
        F.when(F.col("o_orderstatus") == "P", F.lit("steady")).alias("exercise_notes"),
        F.lit("one").alias("source"),
    )
    return parse_set_log(rows).drop("source")


@query
def workouts_first_session(spark, sf):
    log = b.workout_rows(spark, sf).withColumnRenamed("seq", "pos").withColumn("source", F.lit("one"))
    return split_log(log)[0].drop("source")


@query
def overlapping_exports(spark, sf):
    """Two exports of each user, one landed later and with all sessions: shared days count once."""
    log = b.workout_rows(spark, sf).withColumnRenamed("seq", "pos").withColumn("exercise", F.col("title"))
    early = log.filter(F.col("pos") % 3 != 0).withColumn("source", F.lit("2024-01-01 b.csv"))
    late = log.withColumn("source", F.lit("2024-02-01 a.csv"))
    sessions, rows = split_log(early.unionByName(late))
    counts = rows.groupBy(*DAY).agg(F.count("*").alias("n_sets"))
    return sessions.join(counts, DAY).select(*DAY, "title", "duration", "seq", "source", "n_sets")


@query
def legacy_sessions(spark, sf):
    """First-version rows with unreadable dates among them: title of the first row, no duration."""
    text = F.when(F.col("o_orderkey") % 11 == 0, "soon").otherwise(F.date_format(b.day(), "yyyy-MM-dd"))
    digits = (F.col("o_orderkey") % 7).cast("string")
    rows = b.table(spark, sf, "orders").select(
        b.user().alias("user_id"), iso_date(text).alias("date"), F.col("o_orderkey").alias("pos"),
        F.col("o_orderpriority").alias("title"), F.col("o_orderstatus").alias("exercise"), F.lit("normal").alias("set_type"),
        F.when(digits == "0", "").otherwise(digits).alias("weight_lbs"), digits.alias("reps"), F.lit("").alias("distance_miles"),
        F.lit("").alias("duration_seconds"), F.lit("").alias("rpe"), F.lit(None).cast("string").alias("notes"), F.lit("one").alias("source"),
    )
    log = legacy_log(rows)
    first = days.workouts_of_sets(log)
    weighted = F.count(F.when(is_weighted(F.col("weight_lbs").try_cast("double")), 1))
    counts = log.groupBy(*DAY).agg(F.count("*").alias("n_sets"), F.count("weight_lbs").alias("n_numbers"), weighted.alias("n_weighted"))
    return first.join(counts, DAY).select(*DAY, "title", "duration", "seq", "n_sets", "n_numbers", "n_weighted")


@query
def workouts_last_record(spark, sf):
    return days.last_workout_wins(b.workout_rows(spark, sf))


@query
def load_audit_sets(spark, sf):
    return load_audit(b.raw_sets(spark, sf), "sets")


@query
def date_preview(spark, sf):
    return preview(b.series(spark, sf))


# --- combine ----------------------------------------------------------------------------


@query
def sets_effective_weight(spark, sf):
    return b.sets(spark, sf).select(
        *DAY, "pos", "tie", "exercise", "set_type", "raw_weight_lbs", "weight_lbs", "reps", "distance", "notes",
        F.array_join("muscle_groups", ",").alias("muscles"),
    )


@query
def sets_calories(spark, sf):
    return b.sets(spark, sf).select(*DAY, "pos", "tie", "raw_weight_lbs", six("calories"))


@query
def workout_calories_day(spark, sf):
    return days.day_calories(b.sets(spark, sf))


@query
def unmapped_exercises(spark, sf):
    return dims.unmapped_exercises(b.raw_sets(spark, sf), b.dims(spark, sf))


@query
def combine_daily(spark, sf):
    return b.daily(spark, sf).withColumn("sleep_hours", six("sleep_hours"))


@query
def averages(spark, sf):
    means = trends.averages(b.daily(spark, sf))
    return means.select("user_id", *(six(c) for c in means.columns if c != "user_id"))


def _merged_months(spark, sf):
    return merged(month_parts(b.daily(spark, sf)))


@query
def averages_by_month(spark, sf):
    """The averages from stored sums and counts of months."""
    means = averages_of(_merged_months(spark, sf))
    return means.select("user_id", *(six(c) for c in means.columns if c != "user_id"))


@query
def nonzero_means_by_month(spark, sf):
    lines = reference_lines_of(_merged_months(spark, sf))
    return lines.select("user_id", *(six(f"avg_{c}") for c in trends.CHARTED))


@query
def valid_range_by_month(spark, sf):
    return valid_ranges_of(_merged_months(spark, sf))


@query
def newest_days_after_update(spark, sf):
    """The eight newest days of each user when January is replaced by a fuller January beside a stored state."""
    days = b.workout_rows(spark, sf).select(*DAY).distinct().withColumn("summary", F.col("date").cast("string"))
    january = F.date_format("date", "yyyy-MM") == "2024-01"
    stored = newest_summaries(days.filter(~january | (F.dayofmonth("date") % 3 != 0)))
    kept, short = newest_state(stored, days.filter(january), ["2024-01"])
    again = newest_summaries(days.join(short, "user_id", "left_semi"))
    return kept.join(short, "user_id", "left_anti").unionByName(again)


@query
def averages_text(spark, sf):
    return trends.averages_lines(trends.averages(b.daily(spark, sf)))


@query
def averages_report(spark, sf):
    return trends.averages_report(trends.averages(b.daily(spark, sf)))


# --- workouts ---------------------------------------------------------------------------


@query
def exercise_stats(spark, sf):
    stats = workouts.exercise_stats(b.exercise_groups(spark, sf))
    return stats.select(
        *DAY, "exercise", "sets", "reps_sum", six("avg_weight"), six("avg_reps"), round_exact(F.col("score"), 2).alias("score"),
        F.array_join("muscles", ",").alias("muscles"),
    )


@query
def day_totals(spark, sf):
    return workouts.workout_totals(b.exercise_groups(spark, sf))


@query
def muscle_sets_day(spark, sf):
    return workouts.muscle_sets(b.exercise_groups(spark, sf)).drop("met_at")


@query
def workout_focus(spark, sf):
    return workouts.workout_focus(b.exercise_groups(spark, sf), **b.FOCUS)


@query
def key_lifts_top3(spark, sf):
    lifts = workouts.key_lifts(workouts.exercise_stats(b.exercise_groups(spark, sf)))
    return lifts.withColumn("muscles", F.array_join("muscles", ","))


@query
def workout_notes(spark, sf):
    return workouts.workout_notes(b.plain_sets(spark, sf), b.exercise_groups(spark, sf))


def _summary_rows(summaries: DataFrame) -> DataFrame:
    """Summaries in flat columns; the map as sorted text."""
    entries = F.transform(
        F.array_sort(F.map_entries("summary.volume_sets")), lambda e: F.concat(e.key, F.lit("="), e.value)
    )
    return summaries.select(
        *DAY,
        "recency",
        "summary.focus",
        F.array_join(entries, ",").alias("volume_sets"),
        "summary.total_sets",
        "summary.total_reps",
        "summary.estimated_volume",
        F.array_join(F.transform("summary.key_lifts", lambda x: x.exercise), ",").alias("key_lifts"),
        "summary.notes",
    )


@query
def recent_workouts(spark, sf):
    return _summary_rows(coach.recent_summaries(b.sets(spark, sf), 3, sets_of=partial(b.sets, spark, sf)))


@query
def oldest_workouts(spark, sf):
    return _summary_rows(coach.recent_summaries(b.sets(spark, sf), 2, newest=False, sets_of=partial(b.sets, spark, sf)))


@query
def set_numbers(spark, sf):
    numbered = workouts.numbered_sets(b.sets(spark, sf))
    return numbered.select(*DAY, "exercise", "pos", "tie", "weight_lbs", "set_number")


@query
def exercise_last_note(spark, sf):
    return workouts.exercise_last_note(b.sets(spark, sf)).drop("exercise_first")


@query
def workout_text(spark, sf):
    return workouts.workout_text(b.sets(spark, sf))


# --- coach payload ----------------------------------------------------------------------


@query
def week_volume(spark, sf):
    return weeks.week_volume(b.sets(spark, sf), b.PLAN_DAY)


@query
def prior_day_lookup(spark, sf):
    found = coach.prior_day(b.daily(spark, sf), b.PLAN_DAY)
    return found.select("user_id", six("hours"), "score", "resting_hr", "bodyweight")


@query
def low_sleep_flag(spark, sf):
    return b.daily(spark, sf).select(*DAY, low_sleep(F.col("sleep_hours")).alias("low_sleep"))


def _counts_text(counts: Column) -> Column:
    """A map of counts as sorted text."""
    entries = F.array_sort(F.map_entries(counts))
    return F.array_join(F.transform(entries, lambda e: F.concat(e.key, F.lit("="), e.value)), ",")


def _summary_text(w: Column) -> Column:
    """All parts of a nested summary in one line."""
    return F.concat_ws(
        "|", w.date, w.focus, _counts_text(w.volume_sets), w.total_sets, w.total_reps,
        F.format_string("%.1f", w.estimated_volume), F.array_join(F.transform(w.key_lifts, lambda x: x.exercise), ","), w.notes,
    )


@query
def payload_flat(spark, sf):
    payload = jobs.build_payload(b.combined(spark, sf), b.PLAN_DAY)
    total = F.aggregate(F.map_values("week_volume"), F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    return payload.select(
        "user_id",
        "date_for_plan",
        round_exact(F.col("sleep_last_night.hours"), 6).alias("hours"),
        "sleep_last_night.score",
        "bodyweight",
        F.size("week_volume").alias("week_muscles"),
        total.alias("week_sets"),
        F.size("recent_workouts").alias("n_recent"),
        F.col("last_workout_summary.had_workout").alias("had_workout"),
        F.col("last_workout_summary.date").alias("last_date"),
        F.col("last_workout_summary.total_sets").alias("last_sets"),
        F.array_join(F.transform("recent_workouts", lambda w: w.date), ",").alias("recent_dates"),
        _counts_text(F.col("week_volume")).alias("week_text"),
        F.array_join(F.transform("recent_workouts", _summary_text), ";").alias("recent_text"),
        "low_sleep_flag",
    )


# --- dashboard --------------------------------------------------------------------------


@query
def dashboard_day(spark, sf):
    combined = b.combined(spark, sf)
    rows = trends.dashboard_days(combined.daily, trends.set_totals(combined.sets, b.dims(spark, sf)))
    return rows.withColumn("sleep_hours", six("sleep_hours"))


@query
def fallback_calories(spark, sf):
    return trends.set_totals(b.sets(spark, sf), b.dims(spark, sf)).select(*DAY, "total_sets", "fallback_calories")


def _charted(spark, sf) -> DataFrame:
    return b.daily(spark, sf).select(
        *DAY, "steps", "sleep_hours", F.col("total_calories_burned").alias("total_calories")
    )


@query
def rolling7(spark, sf):
    rows = trends.rolling_means(_charted(spark, sf))
    return rows.select(*DAY, *(six(f"{c}_rolling") for c in trends.CHARTED))


@query
def global_mean_joined(spark, sf):
    rows = trends.with_user_means(_charted(spark, sf))
    return rows.select(*DAY, "steps", *(six(f"{c}_total_average") for c in trends.CHARTED))


@query
def nonzero_means(spark, sf):
    lines = trends.reference_lines(_charted(spark, sf))
    return lines.select("user_id", *(six(f"avg_{c}") for c in trends.CHARTED))


@query
def reference_labels(spark, sf):
    return trends.reference_labels(trends.reference_lines(_charted(spark, sf)))


@query
def valid_date_range(spark, sf):
    return trends.valid_ranges(_charted(spark, sf))


@query
def steps_bucket(spark, sf):
    rows = _charted(spark, sf).groupBy("user_id").agg(F.avg("steps").alias("mean"))
    return rows.select("user_id", steps_colour(F.col("mean")).alias("colour"))


@query
def weekly_sets(spark, sf):
    return weeks.weekly_sets(b.sets(spark, sf))


@query
def weekly_sets_30d(spark, sf):
    return weeks.weekly_sets_trailing(b.sets(spark, sf))


@query
def weekly_weight_ranked(spark, sf):
    return weeks.weekly_weight_ranked(b.sets(spark, sf))


@query
def progress_rolling3(spark, sf):
    rows = weeks.weekly_progress(b.sets(spark, sf), b.TRACKED)
    return rows.withColumn("volume_rolling", six("volume_rolling"))


@query
def weekly_event_totals(spark, sf):
    return weekly_totals(b.table(spark, sf, "events")).withColumn("total", F.col("total").cast("double"))


# --- feed -------------------------------------------------------------------------------


@query
def metric_feed(spark, sf):
    return jobs.feed_of_all(b.combined(spark, sf))


@query
def feed_point_day(spark, sf):
    return jobs.feed_of_day(b.combined(spark, sf), b.PLAN_DAY)


@query
def feed_range(spark, sf):
    return jobs.feed_of_range(b.combined(spark, sf), FEED_FROM, FEED_TO)


@query
def date_spine_missing(spark, sf):
    return feed.missing_days(b.daily(spark, sf), FEED_FROM, FEED_TO)


# --- functions --------------------------------------------------------------------------


@query
def number_formats(spark, sf):
    price = F.col("l_extendedprice")
    return b.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        short_number(price * F.col("l_quantity")).alias("short"),
        thousands(price.cast("bigint")).alias("thousands"),
        round_exact(price / 8, 1).alias("one_decimal"),
        round_whole(price / 2).alias("whole"),
        fixed(price / 4, 1).alias("fixed_1"),
        float_text(price).alias("float_text"),
        round_exact(pounds_to_kg(price), 4).alias("kg"),
        round_exact(km_to_miles(F.col("l_quantity")), 4).alias("miles"),
    )


@query
def duration_formats(spark, sf):
    minutes = F.col("o_totalprice").cast("bigint") % 1500
    text = duration_text(minutes)
    return b.table(spark, sf, "orders").select(
        "o_orderkey",
        text.alias("clock"),
        duration_minutes(text).alias("minutes"),
        hours_minutes_text(F.col("o_totalprice") / 1000).alias("hours_minutes"),
        sleep_text(F.col("o_totalprice") / 50000).alias("sleep"),
    )


@query
def iso_weeks(spark, sf):
    date = F.col("o_orderdate").cast("date")
    return b.table(spark, sf, "orders").select(
        "o_orderkey",
        iso_year(date).cast("bigint").alias("iso_year"),
        iso_week(date).cast("bigint").alias("iso_week"),
        week_start(date).alias("week_start"),
    )


# --- plans and rendering ----------------------------------------------------------------


def plan_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model texts: bare, fenced, with a leading word, broken, and without lists."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    weight = F.when(kind == "click", F.concat(F.lit('"'), k, F.lit('-100"'))).otherwise(k)
    lift = F.concat(
        F.lit('{"exercise": "lift '), k, F.lit('", "sets": 4, "reps_range": "5-8", "target_weight_lbs": '), weight,
        F.lit(', "rpe_range": "7", "notes": "slow"}'),
    )
    full = F.concat(
        F.lit('{"day_focus": "'), kind, F.lit('", "warmup": ["walk", "row '), k, F.lit('"], "main_lifts": ['), lift,
        F.lit('], "accessories": [], "conditioning": "bike", "step_goal": "9000", '),
        F.lit('"macros": {"protein_target_g": '), k, F.lit(', "notes": "eat"}, "notes": "rest"}'),
    )
    text = (
        F.when(kind == "view", full)
        .when(kind == "click", F.concat(F.lit("```json\n"), full, F.lit("\n```  ")))
        .when(kind == "purchase", F.concat(F.lit("json\n"), full, F.lit(" \n")))
        .when(kind == "signup", F.lit("no plan today"))
        .otherwise(F.concat(F.lit('{"day_focus": "easy '), k, F.lit('"}')))
    )
    return b.table(spark, sf_dir, "events").select("event_id", "user_id", "ts", text.alias("text"))


@query
def plan_json_extract(spark, sf):
    plans = rendering.plan_rows(plan_texts(spark, sf))
    lift = F.get("plan.main_lifts", F.lit(0))
    return plans.select(
        "event_id",
        "plan.day_focus",
        F.coalesce(F.size("plan.warmup"), F.lit(0)).alias("n_warmup"),
        lift.exercise.alias("lift"),
        lift.sets.alias("sets"),
        lift.target_weight_lbs.alias("target"),
        F.col("plan.macros.protein_target_g").alias("protein"),
        "plan.notes",
    )


@query
def plan_unreadable(spark, sf):
    return rendering.unreadable_plans(plan_texts(spark, sf)).select("event_id", "text")


@query
def plan_html(spark, sf):
    return rendering.plan_rows(plan_texts(spark, sf)).select("event_id", rendering.workout_html().alias("html"))


@query
def plan_card_html(spark, sf):
    return rendering.plan_rows(plan_texts(spark, sf)).select("event_id", rendering.card_html().alias("html"))


TEMPLATE = "<h2>{{date}}</h2><p>{{day_focus}}</p><ul>{{main_lifts}}</ul><p>{{warmup}}</p><p>{{notes}}</p>{{unset}}"


@query
def template_fill(spark, sf):
    slots = rendering.template_slots(F.col("ts").cast("date"))
    plans = rendering.plan_rows(plan_texts(spark, sf))
    return plans.select("event_id", fill_template(TEMPLATE, slots).alias("page"))


@query
def prompt_text(spark, sf):
    customers = b.table(spark, sf, "customer")
    profiles = customers.select(
        F.col("c_custkey").alias("user_id"), F.concat(F.lit("Segment "), F.col("c_mktsegment")).alias("text")
    )
    payload = jobs.build_payload(b.combined(spark, sf), b.PLAN_DAY, 1)
    plain = F.create_map().cast("map<string,bigint>")
    # The week map and the workouts have their own queries; their JSON order is not fixed.
    bare = payload.withColumns(
        {
            "week_volume": plain,
            "recent_workouts": F.slice("recent_workouts", 1, 0),
            "last_workout_summary": F.struct("last_workout_summary.had_workout"),
        }
    )
    return rendering.prompt_text(bare, profiles, b.PLAN_DAY)


@query
def nested_heart_rate(spark, sf):
    """Heart values as nested records: some without the rate, some no record at all, some absent."""
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.concat(F.lit('{"restingHeartRate": '), k, F.lit(', "zones": []}')))
        .when(kind == 1, F.lit('{"zones": []}'))
        .when(kind == 2, F.concat(F.lit('"'), k, F.lit('"')))
    )
    rows = b.table(spark, sf, "events").select(
        "user_id", F.col("ts").cast("date").alias("date"), F.lit("heart").alias("metric"), text.alias("value"), F.col("event_id").alias("seq")
    )
    return days.typed_series(rows).select(*DAY, "seq", "value")


@query
def malformed_sets_skipped(spark, sf):
    """Sets of combined records whose lists hold null and nameless entries."""
    key = F.col("o_orderkey")

    def entry(name: Column) -> Column:
        fields = {"exercise": name, "set_type": F.lit("normal"), "weight_lbs": F.col("o_totalprice"), "reps": key % 20}
        none = {"distance": F.lit(None), "notes": F.lit(None), "muscle_groups": F.lit(None)}
        return F.struct(*(c.alias(n) for n, c in (fields | none).items())).cast(COMBINED_SET)

    entries = F.array(
        entry(F.col("o_orderpriority")), F.when(key % 3 != 0, entry(F.lit("B"))), entry(F.when(key % 2 == 0, F.lit("C")))
    )
    records = b.table(spark, sf, "orders").select(
        b.user().alias("user_id"), b.day().alias("date"), F.struct(F.when(key % 7 != 0, entries).alias("exercises")).alias("record")
    )
    return combined_sets(records).select(*DAY, "pos", "exercise", "weight_lbs", "reps", "notes", F.size("muscle_groups").alias("n_muscles"))
