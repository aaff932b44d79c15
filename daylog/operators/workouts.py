"""Per-workout summaries: muscle counts, focus, key lifts, notes, recent days and workout text.

Set rows are read once and reduced to one row per user, day and exercise (``exercise_groups``). Every
figure of a workout comes from that table. Its measures sit in one collected column, so all consumers
need the same columns and Spark reuses one shuffle for them.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import focus_of, muscle_key
from ..functions.numbers import exact_sum, is_truthy_number, is_truthy_text, round_exact
from ..functions.text import strip, strip_left
from ..schemas import DAY
from .dims import attach_dim
from .ranking import number_rows, position_block, top_rows, with_keys

# How many lifts and notes a summary shows, how they are joined, the nameless exercise.
KEY_LIFTS = 3
NOTES_SHOWN = 5
NOTE_SEPARATOR = " | "
UNKNOWN_EXERCISE = "unknown"
# Group totals; partial sums of it stay within Spark's widest decimal.
TOTAL = "decimal(38,6)"


def _name(exercise: Column) -> Column:
    named = F.when(is_truthy_text(exercise), exercise).otherwise(F.lit(UNKNOWN_EXERCISE))
    return strip(named)


def reduce_sets(sets: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Set rows -> one row per user, day, written exercise and muscle list, with sums that do not depend
    on task order. The partial aggregate runs before the shuffle, so a hot day is reduced where it lies.

    With ``dim`` the sets bring no muscles: they are looked up once per reduced row.
    """
    weight, reps = F.col("weight_lbs"), F.coalesce("reps", F.lit(0))
    weighted = is_truthy_number(weight)
    muscles = [] if dim is not None else ["muscle_groups"]
    reduced = (
        with_keys(sets, *DAY)
        .groupBy(*DAY, "exercise", *muscles)
        .agg(
            F.count("*").alias("sets"),
            F.sum(reps).cast("bigint").alias("reps"),
            F.coalesce(exact_sum(F.when(weighted, weight)), F.lit(0)).cast(TOTAL).alias("weight"),
            F.count(F.when(weighted, 1)).alias("weighted"),
            F.coalesce(exact_sum(F.when(weighted, weight * reps)), F.lit(0)).cast(TOTAL).alias("volume"),
            F.min("pos").alias("first_pos"),
        )
    )
    if dim is not None:
        reduced = attach_dim(reduced, dim)
    return reduced.withColumn("exercise", _name(F.col("exercise")))


def collect_parts(reduced: DataFrame) -> DataFrame:
    """Reduced rows -> one row per user, day and exercise with ``parts``, one per written name.

    The rows are placed by user and day, and every figure of a day is worked out where they lie: stats,
    totals, muscles, focus and lifts share this one exchange.
    """
    part = F.struct("muscle_groups", "sets", "reps", "weight", "weighted", "volume", "first_pos")
    return reduced.repartition(*DAY).groupBy(*DAY, "exercise").agg(F.collect_list(part).alias("parts"))


def exercise_groups(sets: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Set rows -> one row per user, day and exercise with the sums of its ``parts``."""
    return collect_parts(reduce_sets(sets, dim))


def _total(field: str, type_name: str = "bigint") -> Column:
    zero = F.lit(0).cast(type_name)
    return F.aggregate("parts", zero, lambda acc, part: (acc + part.getField(field)).cast(type_name))


def _listed(muscles: Column) -> Column:
    return F.coalesce(muscles, F.array().cast("array<string>"))


def exercise_opening() -> Column:
    """Position of the first set of an exercise of ``exercise_groups``."""
    return F.array_min(F.transform("parts", lambda part: part.first_pos))


def exercise_stats(groups: DataFrame) -> DataFrame:
    """Sets, reps, mean weight over weighted sets, mean reps over all sets, muscles and score: a
    projection, no shuffle."""
    muscles = F.flatten(
        F.transform("parts", lambda part: F.transform(_listed(part.muscle_groups), muscle_key))
    )
    summed = groups.select(
        *DAY,
        "exercise",
        _total("sets").alias("sets"),
        _total("reps").alias("reps_sum"),
        _total("weight", TOTAL).cast("double").alias("weight_sum"),
        _total("weighted").alias("weighted"),
        _total("volume", TOTAL).alias("volume"),
        F.array_sort(F.array_distinct(muscles)).alias("muscles"),
        exercise_opening().alias("first_pos"),
    )
    avg_weight = F.col("weight_sum") / F.nullif(F.col("weighted"), F.lit(0))
    avg_reps = F.col("reps_sum") / F.col("sets")
    score = F.coalesce("avg_weight", F.lit(0.0)) * F.col("avg_reps") * F.col("sets")
    return (
        summed.withColumns({"avg_weight": avg_weight, "avg_reps": avg_reps})
        .withColumn("score", score)
        .select(*DAY, "exercise", "sets", "reps_sum", "avg_weight", "avg_reps", "score", "volume", "muscles", "first_pos")
    )


def workout_totals(groups: DataFrame) -> DataFrame:
    return exercise_stats(groups).groupBy(*DAY).agg(
        F.sum("sets").alias("total_sets"),
        F.sum("reps_sum").alias("total_reps"),
        round_exact(F.sum("volume").cast("double"), 1).alias("estimated_volume"),
    )


def muscle_sets(groups: DataFrame) -> DataFrame:
    """Sets per muscle of a day, with where the muscle was first met."""
    return _muscle_rows(groups).filter(F.col("muscle").isNotNull())


def _muscle_rows(groups: DataFrame) -> DataFrame:
    """``muscle_sets``, and a row without a muscle for exercises that have none."""
    parts = groups.select(*DAY, "exercise", exercise_opening().alias("opening"), F.explode("parts").alias("part"))
    named = parts.select(
        *DAY, "exercise", "opening", "part", F.posexplode_outer("part.muscle_groups").alias("place", "muscle")
    )
    met_at = F.struct("opening", "exercise", F.col("part.first_pos").alias("first_pos"), "place")
    return named.groupBy(*DAY, F.when(F.col("muscle").isNotNull(), muscle_key(F.col("muscle"))).alias("muscle")).agg(
        F.sum("part.sets").alias("sets"), F.min(met_at).alias("met_at")
    )


def _top_muscle() -> Column:
    """The muscle with most sets; of equals the one met first."""
    return F.min_by("muscle", F.when(F.col("muscle").isNotNull(), F.struct(-F.col("sets"), F.col("met_at"))))


def workout_focus(groups: DataFrame, **classes) -> DataFrame:
    """Focus of each day with sets: push, pull, legs or the top muscle; ``other`` without muscles."""
    best = _muscle_rows(groups).groupBy(*DAY).agg(_top_muscle().alias("top_muscle"))
    return best.select(*DAY, focus_of(F.col("top_muscle"), **classes).alias("focus"))


def key_lifts(stats: DataFrame, n: int = KEY_LIFTS) -> DataFrame:
    """Top ``n`` exercises of a day by score; of equals the one done first."""
    order = [F.desc("score"), F.asc("first_pos"), F.asc("exercise")]
    return top_rows(stats, DAY, order, n).select(
        *DAY,
        "rank",
        "exercise",
        "sets",
        round_exact(F.col("avg_weight"), 1).alias("avg_weight"),
        round_exact(F.col("avg_reps"), 1).alias("avg_reps"),
        "muscles",
    )


def workout_notes(sets: DataFrame, groups: DataFrame, n: int = NOTES_SHOWN) -> DataFrame:
    """First ``n`` non-empty notes of a day joined, by first set of the exercise, then by set.

    Notes are limited per exercise before they are shuffled, then joined to the exercises of
    ``groups`` (which may hold chosen days only) and limited per day.
    """
    rows = sets.select(*DAY, _name(F.col("exercise")).alias("exercise"), "pos", F.col("notes").alias("note"))
    opened = groups.select(*DAY, "exercise", exercise_opening().alias("exercise_first"))
    noted = rows.filter(is_truthy_text(F.col("note")))
    per_exercise = top_rows(noted, [*DAY, "exercise"], [F.asc("pos"), F.asc("note")], n).drop("rank")
    order = [F.asc("exercise_first"), F.asc("exercise"), F.asc("pos"), F.asc("note")]
    per_day = top_rows(per_exercise.join(opened, [*DAY, "exercise"]), DAY, order, n)
    parts = F.array_sort(F.collect_list(F.struct("rank", strip(F.col("note")).alias("note"))))
    return per_day.groupBy(*DAY).agg(F.array_join(F.transform(parts, lambda p: p.note), NOTE_SEPARATOR).alias("notes"))


def training_days(sets: DataFrame, n: int, newest: bool = True, until: datetime.date | None = None) -> DataFrame:
    """The last (or first) ``n`` days with sets per user, numbered; optionally not after ``until``.

    Reads two columns. A user has at most one row per calendar day when days are ranked.
    """
    days = with_keys(sets.select(*DAY), *DAY).distinct()
    if until is not None:
        days = days.filter(F.col("date") <= F.lit(until))
    order = F.desc("date") if newest else F.asc("date")
    return top_rows(days, ["user_id"], [order], n, "recency")


def summaries(groups: DataFrame, notes: DataFrame, **classes) -> DataFrame:
    """One summary struct per day with sets. Every collected list is bounded: three lifts, one entry
    per muscle."""
    lift = F.struct("rank", "exercise", "sets", "avg_weight", "avg_reps", "muscles")
    lifts = key_lifts(exercise_stats(groups)).groupBy(*DAY).agg(F.array_sort(F.collect_list(lift)).alias("lifts"))
    by_muscle = (
        muscle_sets(groups)
        .groupBy(*DAY)
        .agg(
            _top_muscle().alias("top_muscle"),
            F.array_sort(F.collect_list(F.struct("met_at", "muscle", "sets"))).alias("counts"),
        )
    )
    entries = F.transform("counts", lambda c: F.struct(c.muscle, c.sets))
    no_entries = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<bigint>"))
    joined = workout_totals(groups).join(lifts, DAY).join(by_muscle, DAY, "left").join(notes, DAY, "left")
    summary = F.struct(
        F.col("date").cast("string").alias("date"),
        F.lit(True).alias("had_workout"),
        focus_of(F.col("top_muscle"), **classes).alias("focus"),
        F.coalesce(F.map_from_entries(entries), no_entries).alias("volume_sets"),
        "total_sets",
        "total_reps",
        "estimated_volume",
        F.transform("lifts", lambda x: x.dropFields("rank")).alias("key_lifts"),
        F.coalesce("notes", F.lit("")).alias("notes"),
    )
    return joined.select(*DAY, summary.alias("summary"))


def set_ties(sets: DataFrame) -> list[str]:
    """Columns that order sets of equal position, so that every step sees the same total order:
    position, then these."""
    return [c for c in ("tie", "weight_lbs", "reps", "notes") if c in sets.columns]


def set_order(sets: DataFrame) -> list[Column]:
    """The order of sets: position, then content where positions are equal."""
    return [F.asc("pos"), *(F.asc_nulls_first(c) for c in set_ties(sets))]


def numbered_sets(sets: DataFrame) -> DataFrame:
    """Set number within the exercise of a day, exact for exercises of any size."""
    rows = with_keys(sets.withColumn("block", position_block()), *DAY, "exercise", "block")
    return number_rows(rows, [*DAY, "exercise"], set_order(sets), "set_number").drop("block")


def exercise_last_note(sets: DataFrame) -> DataFrame:
    """Last non-empty note of each exercise of a day, where the exercise begins, and its sets."""
    order = F.struct("pos", *set_ties(sets))
    noted = is_truthy_text(F.col("notes"))
    return sets.groupBy(*DAY, "exercise").agg(
        F.max_by(F.when(noted, F.col("notes")), F.when(noted, order)).alias("note"),
        F.min("pos").alias("exercise_first"),
        F.count("*").alias("n_sets"),
    )


def _set_text(number: Column, entry: Column) -> Column:
    reps = F.coalesce(entry.reps.cast("string"), F.lit("None"))
    start = F.concat(F.lit("Set "), number.cast("string"), F.lit(": "))
    loaded = F.concat(entry.weight_lbs.cast("bigint").cast("string"), F.lit(" lbs x "), reps)
    return F.concat(start, F.when(is_truthy_number(entry.weight_lbs), loaded).otherwise(F.concat(reps, F.lit(" reps"))))


def workout_pieces(sets: DataFrame) -> DataFrame:
    """Workout text in pieces of bounded size: one per exercise and position block, in print order.

    Sets are placed by user and day once. Where they lie they meet in (day, exercise, block), and windows over these pieces tell
    each its first set number and line, so nothing is shuffled again, neither here nor when the pieces of a day are joined.
    """
    entry = F.struct("pos", *set_ties(sets))
    cell = [*DAY, "exercise", "block"]
    cells = (
        with_keys(sets.withColumn("block", position_block()), *cell)
        .repartition(*DAY)
        .groupBy(*cell)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    )
    noted = F.filter("entries", lambda e: is_truthy_text(e.notes))
    sized = cells.select(
        *cell,
        "entries",
        F.size("entries").cast("bigint").alias("size"),
        F.element_at("entries", 1).pos.alias("first_pos"),
        F.when(F.size(noted) > 0, F.element_at(noted, -1).notes).alias("note"),
    )
    exercise = Window.partitionBy(*DAY, "exercise")
    earlier = exercise.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumns(
        {
            "before": F.coalesce(F.sum("size").over(earlier), F.lit(0)),
            "opening": F.min("first_pos").over(exercise),
            "note": F.max_by("note", F.when(F.col("note").isNotNull(), F.col("block"))).over(exercise),
        }
    )
    # A piece that opens an exercise has one header line more than sets.
    opens = F.col("before") == 0
    lines = F.col("size") + F.when(opens, 1).otherwise(0)
    above = Window.partitionBy(*DAY).orderBy("opening", "exercise", "block")
    line = F.coalesce(F.sum(lines).over(above.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    gap = F.when(F.col("line") > 0, F.lit("\n")).otherwise(F.lit(""))
    quoted = F.coalesce(F.concat(F.lit('\n"'), F.col("note"), F.lit('"')), F.lit(""))
    header = F.when(opens, F.concat(gap, F.col("exercise"), quoted, F.lit("\n"))).otherwise(F.lit(""))
    texts = F.transform("entries", lambda e, i: _set_text(F.col("before") + i + 1, e))
    return placed.withColumn("line", line).select(*DAY, "line", F.concat(header, F.array_join(texts, "\n")).alias("text"))


def workout_text(sets: DataFrame) -> DataFrame:
    """The text of each workout: one row per user and day, whatever its length."""
    pieces = F.array_sort(F.collect_list(F.struct("line", "text")))
    whole = workout_pieces(sets).groupBy(*DAY).agg(F.array_join(F.transform(pieces, lambda p: p.text), "\n").alias("text"))
    # The text ends in a set line, so only its beginning can hold blanks to strip.
    return whole.select(*DAY, strip_left(F.col("text")).alias("text"))
