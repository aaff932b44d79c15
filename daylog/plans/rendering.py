"""Plan responses and rendered text: JSON extraction, two HTML layouts and the coach prompt.

All of it is projection: a table of plans or payloads goes in, one text per row comes out.
"""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import fill_template, strip_code_fences
from ..operators.ranking import top_rows
from ..schemas import BAD_PLAN_ROW, DAY, PLAN, STORED_PLAN
from ..sources.store import WHOLE, drop_folder, merge_into, read_table
from .paths import Store

# The texts of the two mail layouts and of the prompt.
WORKOUT_PAGE = """
    <html>
    <body>
        <h2>Today's Workout</h2>
        <h3>Focus</h3><p>{{focus}}</p>

        <h3>Notes</h3><p>{{notes}}</p>

        <h3>Warm Up</h3><ul>{{warmup}}</ul>

        <h3>Main Lifts</h3>{{main_lifts}}

        <h3>Accessories</h3>{{accessories}}

        <h3>Conditioning</h3><p>{{conditioning}}</p>
    </body>
    </html>
    """
MAIN_LIFT_PART = """
        <p><strong>{{exercise}}</strong><br>
        Sets × Reps: {{sets}}×{{reps_range}}<br>
        Weight / Assistance: {{load}}<br>
        RPE: {{rpe_range}}<br>
        Notes: {{notes}}</p>
        """
ACCESSORY_PART = """
        <p><strong>{{exercise}}</strong><br>
        Sets × Reps: {{sets}}×{{reps_range}}<br>
        Weight: {{load}}<br>
        RPE: {{rpe_range}}<br>
        Notes: {{notes}}</p>
        """
CARD_PAGE = """
    <html>
      <body style="font-family: Arial, sans-serif; padding: 20px; color: #222;">
        
        <h2>🏋️ Today's Workout</h2>
        <p style="color: #666;">Automatically generated</p>

        <h3>Focus: {{focus}}</h3>

        <h3>Main Lifts</h3>
        <ul>{{main_lifts}}</ul>

        <h3>Accessories</h3>
        <ul>{{accessories}}</ul>

        <h3>Conditioning</h3>
        <ul>{{conditioning}}</ul>

        <h3>Warmup</h3>
        <ul>{{warmup}}</ul>

        <h3>Notes</h3>
        <p style="white-space: pre-wrap;">{{notes}}</p>

      </body>
    </html>
    """
EMPTY_ITEM = "<li>None</li>"
PROMPT = """
Stable Profile:
{{profile}}

Daily Metrics:
- Sleep: {{hours}} hours, {{score}}
- Resting Heart Rate: {{resting_hr}}
- Bodyweight: {{bodyweight}} lbs


Week Volume:
{{week_volume}}

Recent Workouts:
{{recent_workouts}}

Last Workout:
{{last_workout}}

Today's date:
{{today}}


Please generate today's workout plan, step goal, and macros.
"""

BAD_PLAN = "_bad_plan"


def _plans_in(text: Column) -> Column:
    """The plan in a model text as a list of one or none. The text is parsed once: every check refers
    to the list element, not to the parse."""
    cleaned = strip_code_fences(text)
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_PLAN}
    parsed = F.transform(
        F.array(cleaned), lambda t: F.when(t.startswith("{"), F.from_json(t, f"{PLAN}, {BAD_PLAN} string", options))
    )
    good = F.filter(parsed, lambda p: p.isNotNull() & p.getField(BAD_PLAN).isNull())
    return F.transform(good, lambda p: p.dropFields(BAD_PLAN))


def plan_rows(rows: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text holds a JSON plan, with the record as ``plan``."""
    return rows.select("*", F.explode(_plans_in(F.col(text))).alias("plan"))


def unreadable_plans(rows: DataFrame, text: str = "text") -> DataFrame:
    """Quarantine: model texts that hold no plan."""
    return rows.filter(F.size(_plans_in(F.col(text))) == 0)


def last_landed(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Of several answers for a user's plan date the one that landed last stays, whichever batch brings it."""
    rows = stored.unionByName(batch)
    rest = [c for c in rows.columns if c not in DAY]
    # Answers that landed at once are ordered by their text, so that every run keeps the same one.
    best = F.max_by(F.struct(*rest), F.struct("landed", F.to_json("plan"))).alias("_row")
    return rows.groupBy(*DAY).agg(best).select(*DAY, "_row.*")


def store_plans(texts: DataFrame, store: Store, text: str = "text") -> None:
    """Merge the plans of a batch of model texts into the plan history, with their rendered pages.

    ``texts`` has user_id, the ``date`` a plan is for, and ``landed``, a text or time that rises in the order of landing. The
    history keeps one plan a user and date; ``latest_plans`` is the newest of each user. Each text is parsed once. Texts
    without a plan, and plans without a user or date, go to the quarantine table, where a text that lands again counts once.
    """
    spark = texts.sparkSession
    aside = f"{store.plans}/_batches/{uuid.uuid4().hex}"
    given = texts.select("user_id", F.col("date").cast("date").alias("date"), F.col("landed").cast("string").alias("landed"), F.col(text).alias("text"))
    given.withColumn("plans", _plans_in(F.col("text"))).write.parquet(aside)
    try:
        parsed = spark.read.parquet(aside)
        keyed = F.col("user_id").isNotNull() & F.col("date").isNotNull()
        plans = parsed.filter(keyed).select(*DAY, "landed", F.explode("plans").alias("plan"))
        pages = plans.select(*DAY, "landed", "plan", workout_html().alias("workout_html"), card_html().alias("card_html"))
        merge_into(pages, store.plans, STORED_PLAN, last_landed)
        bad = parsed.filter(~keyed | (F.size("plans") == 0)).drop("plans")
        merge_into(bad, f"{store.bad_rows}/plans", BAD_PLAN_ROW, lambda old, new: old.unionByName(new).distinct(), by=WHOLE)
    finally:
        drop_folder(spark, aside)


def plan_history(spark: SparkSession, store: Store) -> DataFrame:
    """Every stored plan by user and plan date, with its ``month``, by which date ranges prune folders."""
    return read_table(spark, store.plans, STORED_PLAN)


def latest_plans(spark: SparkSession, store: Store, until: datetime.date | None = None) -> DataFrame:
    """The newest plan of each user, not after ``until`` where it is given."""
    rows = plan_history(spark, store).drop("month")
    if until is not None:
        rows = rows.filter(F.col("date") <= F.lit(until))
    return top_rows(rows, ["user_id"], [F.desc("date")], 1, "place").drop("place")


def _empty(items: Column) -> Column:
    return F.coalesce(F.size(items), F.lit(0)) <= 0


def _or(value: Column, default: str) -> Column:
    return F.coalesce(value, F.lit(default))


def _lift_parts(lifts: Column, template: str, load) -> Column:
    def part(lift: Column) -> Column:
        slots = {
            "exercise": _or(lift.exercise, "None"),
            "sets": _or(lift.sets, "None"),
            "reps_range": lift.reps_range,
            "load": load(lift),
            "rpe_range": lift.rpe_range,
            "notes": lift.notes,
        }
        return fill_template(template, slots)

    return F.when(_empty(lifts), F.lit("")).otherwise(F.array_join(F.transform(lifts, part), ""))


def _items(items: Column, text, when_empty: str) -> Column:
    listed = F.array_join(F.transform(items, lambda x: F.concat(F.lit("<li>"), text(x), F.lit("</li>"))), "")
    return F.when(_empty(items), F.lit(when_empty)).otherwise(listed)


def workout_html(plan: str = "plan") -> Column:
    """The mail layout with one paragraph per lift; absent parts stay empty."""
    p = F.col(plan)
    slots = {
        "focus": _or(p.day_focus, "Full Body"),
        "notes": p.notes,
        "warmup": _items(p.warmup, lambda item: item, ""),
        "main_lifts": _lift_parts(
            p.main_lifts, MAIN_LIFT_PART, lambda lift: F.coalesce(lift.target_weight_lbs, lift.assistance_lbs)
        ),
        "accessories": _lift_parts(p.accessories, ACCESSORY_PART, lambda lift: lift.target_weight_lbs),
        "conditioning": p.conditioning,
    }
    return fill_template(WORKOUT_PAGE, slots)


def card_html(plan: str = "plan") -> Column:
    """The card layout: list items, ``None`` for an empty list; lifts are listed as JSON."""
    p = F.col(plan)
    slots = {
        "focus": _or(p.day_focus, "N/A"),
        "main_lifts": _items(p.main_lifts, F.to_json, EMPTY_ITEM),
        "accessories": _items(p.accessories, F.to_json, EMPTY_ITEM),
        "conditioning": _or(p.conditioning, "[]"),
        "warmup": _items(p.warmup, lambda item: item, EMPTY_ITEM),
        "notes": p.notes,
    }
    return fill_template(CARD_PAGE, slots)


def template_slots(date: Column, plan: str = "plan") -> dict[str, Column]:
    """The seven slots of a plan template."""
    p = F.col(plan)

    def lift_items(lifts: Column) -> Column:
        return _items(lifts, lambda lift: F.coalesce(lift.exercise, F.lit("None")), "")

    return {
        "date": date.cast("string"),
        "day_focus": p.day_focus,
        "main_lifts": lift_items(p.main_lifts),
        "accessories": lift_items(p.accessories),
        "conditioning": p.conditioning,
        "warmup": F.array_join(F.coalesce(p.warmup, F.array().cast("array<string>")), ", "),
        "notes": p.notes,
    }


def prompt_text(payload: DataFrame, profiles: DataFrame, today: datetime.date) -> DataFrame:
    """Coach prompt of each user from the payload and the user's profile text.

    Profiles are joined by user; nested parts are written as JSON, absent values as ``None``.
    """

    def shown(value: Column) -> Column:
        return _or(value.cast("string"), "None")

    night = F.col("sleep_last_night")
    slots = {
        "profile": F.col("text"),
        "hours": shown(night.hours),
        "score": shown(night.score),
        "resting_hr": shown(night.resting_hr),
        "bodyweight": shown(F.col("bodyweight")),
        "week_volume": F.to_json("week_volume"),
        "recent_workouts": F.to_json("recent_workouts"),
        "last_workout": F.to_json("last_workout_summary"),
        "today": F.lit(today.isoformat()),
    }
    joined = payload.join(profiles.select("user_id", "text"), "user_id", "left")
    return joined.select("user_id", fill_template(PROMPT, slots).alias("prompt"))
