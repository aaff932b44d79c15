"""Training-log views of the driver's tables.

``events`` become the wearable series, ``orders`` the workouts, ``lineitem`` the sets and ``part``
the exercise dimension. Every view reads its tables whole.
"""

from __future__ import annotations

import datetime
from functools import lru_cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylog.functions.dates import duration_text
from daylog.functions.effort import WeightWords
from daylog.operators import days
from daylog.operators import workouts as workouts_of
from daylog.operators.days import canonical_sets, combine_days, day_calories, typed_sets, wearable_days
from daylog.operators.dims import MAX_BROADCAST_ROWS
from daylog.operators.latest import first_row
from daylog.plans.daily import Combined
from daylog.schemas import DAY

FIRST_DAY = datetime.date(2023, 11, 20)
LOG_DAYS = 71
PLAN_DAY = datetime.date(2024, 1, 17)
USER_SHARE = 10
WORDS = WeightWords(barbell="bolt", assisted="ring", smith="gear", pull_up="gizmo", dip_note="dip")
FOCUS = {"push": ("red", "blue", "bolt"), "pull": ("hot", "cold", "gear"), "legs": ("plate", "rod")}
TRACKED = ("red", "hot", "plate")


@lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a lazy frame; its footer is read once per session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _props_k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("double")


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric long series: one or two metrics per event, later events of a day win."""
    value = F.col("value")

    def metric(event_type: str, name: str, number) -> F.Column:
        row = F.struct(F.lit(name).alias("metric"), number.cast("double").alias("value"))
        return F.when(F.col("event_type") == event_type, row)

    rows = F.array(
        metric("view", "steps", (value * 100).cast("bigint")),
        metric("click", "distance", value),
        metric("click", "weight", _props_k() + 100),
        metric("purchase", "calories_out", (value * 40).cast("bigint")),
        metric("signup", "sleep_duration", (value * 500000).cast("bigint")),
        metric("signup", "sleep_efficiency", _props_k()),
        metric("error", "heart", value.cast("bigint")),
    )
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("ts").cast("date").alias("date"),
        F.col("event_id").alias("seq"),
        F.inline(F.filter(rows, lambda row: row.isNotNull())),
    )


def user() -> F.Column:
    return F.expr(f"o_custkey DIV {USER_SHARE}")


def day() -> F.Column:
    return F.date_add(F.lit(FIRST_DAY), (F.col("o_orderkey") % LOG_DAYS).cast("int"))


def workout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: a session with its title and duration."""
    minutes = F.col("o_totalprice").cast("bigint") % 150
    return table(spark, sf_dir, "orders").select(
        user().alias("user_id"),
        day().alias("date"),
        F.col("o_orderpriority").alias("title"),
        duration_text(minutes).alias("duration"),
        F.col("o_orderkey").alias("seq"),
    )


def workouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_row(workout_rows(spark, sf_dir), DAY, "seq")


def raw_sets(spark: SparkSession, sf_dir: str, of_days: DataFrame | None = None) -> DataFrame:
    """One set per line item; missing weights, repetitions, times and notes are all present.

    With ``of_days`` (user_id, date) the sets of those days alone: orders are chosen before line items meet them.
    """
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    notes = (
        F.when(flag == "R", F.concat(F.lit("gear "), status))
        .when((flag == "A") & (status == "F"), F.lit(" dip "))
        .when((flag == "N") & (status == "O"), F.lit(None))
        .otherwise(F.lit(""))
    )
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    if of_days is not None:
        wanted = of_days.select(F.col("user_id").alias("of_user"), F.col("date").alias("of_date"))
        orders = orders.join(wanted, (user() == F.col("of_user")) & (day() == F.col("of_date")), "left_semi")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
        parts, lines.l_partkey == parts.p_partkey
    )
    return joined.select(
        user().alias("user_id"),
        day().alias("date"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("pos"),
        F.col("l_partkey").alias("tie"),
        F.col("p_name").alias("exercise"),
        flag.alias("set_type"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).alias("weight_lbs"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity").cast("int")).alias("reps"),
        F.when(F.col("l_linenumber") == 7, F.col("l_quantity").cast("int") + 30).alias("duration_seconds"),
        F.when(F.col("l_linenumber") == 1, F.col("l_tax")).alias("distance_miles"),
        notes.alias("notes"),
    )


def dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Muscles and intensities by exercise name; both miss some names. Broadcast if proven small."""
    name = F.col("p_name")
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    dim = names.select(
        name.alias("exercise"),
        F.when(~name.endswith("gizmo"), F.split(name, " ")).alias("muscle_groups"),
        F.when(name < "m", (4 + F.length(name) % 5).cast("double")).alias("met"),
    )
    return F.broadcast(dim) if _few_names(spark, sf_dir) else dim


@lru_cache(maxsize=8)
def _few_names(spark: SparkSession, sf_dir: str) -> bool:
    """Whether the exercise names fit the broadcast bound; asked once per session and folder."""
    names = table(spark, sf_dir, "part").select("p_name").distinct()
    return names.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS


def sets(spark: SparkSession, sf_dir: str, of_days: DataFrame | None = None) -> DataFrame:
    """Canonical sets: muscles, effective weight and energy attached."""
    return canonical_sets(typed_sets(raw_sets(spark, sf_dir, of_days)), dims(spark, sf_dir), 160.0, WORDS)


def plain_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets with their effective weight, without muscles and energy."""
    return days.plain_sets(typed_sets(raw_sets(spark, sf_dir)), 160.0, WORDS)


def exercise_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return workouts_of.exercise_groups(plain_sets(spark, sf_dir), dims(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined(spark, sf_dir).daily


def combined(spark: SparkSession, sf_dir: str) -> Combined:
    training = sets(spark, sf_dir)
    wearable = wearable_days(series(spark, sf_dir))
    return Combined(combine_days(wearable, workouts(spark, sf_dir), day_calories(training)), training, partial(sets, spark, sf_dir))
