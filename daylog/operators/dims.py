"""Exercise dimensions and size-checked lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.effort import DEFAULT_MET

# Exercise, muscles, intensity. None: not in that table, the default applies.
EXERCISES_V3 = [
    ("Pull Up", ["Back"], 8.0),
    ("Pull Up (Assisted)", ["Back"], 6.0),
    ("Neutral Grip Pull Up", ["Back", "Forearm"], None),
    ("Neutral Grip Pull Up (Assisted)", ["Back", "Forearm"], None),
    ("Chin Up", ["Biceps", "Back"], 8.0),
    ("Chin Up (Assisted)", ["Biceps", "Back"], 6.0),
    ("Bent Over Row (Barbell)", ["Back", "Rear Delts"], 6.0),
    ("Seated Row (Machine)", ["Back", "Rear Delts"], 5.5),
    ("Lat Pulldown (Cable)", ["Back", "Biceps"], 5.5),
    ("Lat Pulldown - Close Grip (Cable)", ["Back", "Biceps"], 5.5),
    ("lat pulldown Burn Outs", ["Back"], 5.5),
    ("Negative Pull Up", ["Back", "Biceps"], 7.0),
    ("Bench Press", ["Chest", "Triceps", "Shoulders"], 6.0),
    ("Incline Bench Press", ["Chest", "Shoulders", "Triceps"], 6.0),
    ("Incline Bench Press (Barbell)", ["Chest", "Shoulders", "Triceps"], 6.0),
    ("Incline Bench Press (Dumbbell)", ["Chest", "Shoulders", "Triceps"], 6.0),
    ("Overhead Press", ["Shoulders"], 5.5),
    ("Overhead Press (Barbell)", ["Shoulders"], 5.5),
    ("Overhead Press (Smith Machine)", ["Shoulders"], 5.5),
    ("Shoulder Press (Dumbbell)", ["Shoulders"], 5.5),
    ("Seated Shoulder Press (Machine)", ["Shoulders"], 5.0),
    ("Chest Dip", ["Chest", "Triceps", "Shoulders"], 6.0),
    ("Chest Dip (Assisted)", ["Chest", "Triceps", "Shoulders"], 5.0),
    ("Push Up", ["Chest", "Triceps", "Shoulders"], 5.5),
    ("Face Pull", ["Rear Delts", "Traps"], 4.5),
    ("Triceps Extension (Barbell)", ["Triceps"], 4.0),
    ("Triceps Extension (Cable)", ["Triceps"], 4.0),
    ("Triceps Rope Pushdown", ["Triceps"], 4.0),
    ("Overhead Triceps Extension (Cable)", ["Triceps"], None),
    ("Hammer Curl (Dumbbell)", ["Biceps", "Forearms"], 4.0),
    ("Bicep Curl (Barbell)", ["Biceps"], 4.0),
    ("EZ Bar Biceps Curl", ["Biceps"], 4.0),
    ("Bicep Curl (Cable)", ["Biceps"], 4.0),
    ("Reverse Curl (Barbell)", ["Biceps", "Forearms"], 4.0),
    ("Lateral Raise (Dumbbell)", ["Shoulders"], 3.5),
    ("Single Arm Lateral Raise (Cable)", ["Shoulders"], 3.5),
    ("Lateral Raise (Cable)", ["Shoulders"], 3.5),
    ("Rear Delt Reverse Fly (Machine)", ["Rear Delts"], 4.0),
    ("Squat", ["Quads", "Glutes", "Hamstrings"], 7.0),
    ("Squat (Barbell)", ["Quads", "Glutes", "Hamstrings"], 7.0),
    ("Front Squat", ["Quads", "Glutes", "Hamstrings"], 7.0),
    ("Leg Press Horizontal (Machine)", ["Quads", "Glutes"], 6.5),
    ("Bulgarian Split Squat", ["Quads", "Glutes", "Hamstrings"], 6.5),
    ("Deadlift", ["Hamstrings", "Glutes", "Back"], 7.0),
    ("Deadlift (Barbell)", ["Hamstrings", "Glutes", "Back"], 7.0),
    ("Romanian Deadlift (Barbell)", ["Hamstrings", "Glutes", "Back"], 6.5),
    ("Hip Thrust (Barbell)", ["Glutes", "Hamstrings"], 6.0),
    ("Hanging Knee Raise", ["Abs"], 3.5),
    ("Leg Raise Parallel Bars", ["Abs"], 3.5),
]
# The same of the second version.
EXERCISES_V2 = [
    ("Pull Up", ["Back"], 8.0),
    ("Pull Up (Assisted)", ["Back"], 6.0),
    ("Chin Up", ["Biceps", "Back"], 8.0),
    ("Chin Up (Assisted)", ["Biceps", "Back"], 6.0),
    ("Bent Over Row (Barbell)", ["Back", "Rear Delts"], 6.0),
    ("Seated Row (Machine)", ["Back", "Rear Delts"], 5.5),
    ("Lat Pulldown (Cable)", ["Back", "Biceps"], 5.5),
    ("Lat Pulldown - Close Grip (Cable)", ["Back", "Biceps"], 5.5),
    ("lat pulldown Burn Outs", ["Back"], None),
    ("Negative Pull Up", ["Back", "Biceps"], 7.0),
    ("Bench Press", ["Chest", "Triceps", "Shoulders"], 6.0),
    ("Incline Bench Press", ["Chest", "Shoulders", "Triceps"], 6.0),
    ("Incline Bench Press (Barbell)", ["Chest", "Shoulders", "Triceps"], 6.0),
    ("Incline Bench Press (Dumbbell)", ["Chest", "Shoulders", "Triceps"], 6.0),
    ("Overhead Press", ["Shoulders", "Triceps"], 5.5),
    ("Overhead Press (Barbell)", ["Shoulders", "Triceps"], 5.5),
    ("Overhead Press (Smith Machine)", ["Shoulders", "Triceps"], 5.5),
    ("Shoulder Press (Dumbbell)", ["Shoulders", "Triceps"], 5.5),
    ("Seated Shoulder Press (Machine)", ["Shoulders", "Triceps"], 5.0),
    ("Chest Dip", ["Chest", "Triceps", "Shoulders"], 6.0),
    ("Chest Dip (Assisted)", ["Chest", "Triceps", "Shoulders"], 5.0),
    ("Push Up", ["Chest", "Triceps", "Shoulders"], 5.5),
    ("Face Pull", ["Rear Delts", "Traps"], 4.5),
    ("Triceps Extension (Barbell)", ["Triceps"], 4.0),
    ("Triceps Extension (Cable)", ["Triceps"], 4.0),
    ("Triceps Rope Pushdown", ["Triceps"], 4.0),
    ("Overhead Triceps Extension (Cable)", ["Triceps"], None),
    ("Hammer Curl (Dumbbell)", ["Biceps", "Forearms"], 4.0),
    ("Bicep Curl (Barbell)", ["Biceps"], 4.0),
    ("EZ Bar Biceps Curl", ["Biceps"], 4.0),
    ("Bicep Curl (Cable)", ["Biceps"], 4.0),
    ("Reverse Curl (Barbell)", ["Biceps", "Forearms"], 4.0),
    ("Lateral Raise (Dumbbell)", ["Shoulders"], 3.5),
    ("Single Arm Lateral Raise (Cable)", ["Shoulders"], 3.5),
    ("Lateral Raise (Cable)", ["Shoulders"], 3.5),
    ("Rear Delt Reverse Fly (Machine)", ["Rear Delts"], 4.0),
    ("Squat", ["Quads", "Glutes", "Hamstrings"], 7.0),
    ("Squat (Barbell)", ["Quads", "Glutes", "Hamstrings"], 7.0),
    ("Front Squat", ["Quads", "Glutes", "Hamstrings"], 7.0),
    ("Leg Press Horizontal (Machine)", ["Quads", "Glutes"], 6.5),
    ("Bulgarian Split Squat", ["Quads", "Glutes", "Hamstrings"], 6.5),
    ("Deadlift", ["Hamstrings", "Glutes", "Back"], 7.0),
    ("Deadlift (Barbell)", ["Hamstrings", "Glutes", "Back"], 7.0),
    ("Romanian Deadlift (Barbell)", ["Hamstrings", "Glutes", "Back"], 6.5),
    ("Hip Thrust (Barbell)", ["Glutes", "Hamstrings"], 6.0),
    ("Hanging Knee Raise", ["Abs"], 3.5),
    ("Leg Raise Parallel Bars", ["Abs"], 3.5),
    ("Lat Pulldown Burn Outs", None, 5.5),
]

DIM_SCHEMA = "exercise string, muscle_groups array<string>, met double"
# A lookup side with more rows than this is joined by shuffle instead of being broadcast.
MAX_BROADCAST_ROWS = 100_000


def exercise_dim(spark: SparkSession, version: int = 3) -> DataFrame:
    """One row per exercise name: muscles and intensity of the given table version."""
    tables = {2: EXERCISES_V2, 3: EXERCISES_V3}
    if version not in tables:
        raise ValueError(f"unknown table version {version}")
    return spark.createDataFrame(tables[version], DIM_SCHEMA)


def merge_dims(muscles: DataFrame, mets: DataFrame) -> DataFrame:
    """One lookup table from separate muscle and intensity tables keyed by exercise."""
    return muscles.join(mets, "exercise", "full_outer").select("exercise", "muscle_groups", "met")


def checked_broadcast(dim: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark a lookup table for broadcast if it is proven small; else leave the join to shuffle.

    The check reads at most ``max_rows + 1`` rows and brings back one count. A table beyond the
    bound is joined by shuffle, where adaptive execution splits a hot key of the large side.
    """
    small = dim.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(dim) if small else dim


def attach_dim(rows: DataFrame, dim: DataFrame, default_met: float = DEFAULT_MET) -> DataFrame:
    """Look up muscles (default: none) and intensity (default: 5) by exact exercise name."""
    extra = [c for c in ("muscle_groups", "met") if c in rows.columns]
    return (
        rows.drop(*extra)
        .join(dim, "exercise", "left")
        .withColumn("muscle_groups", F.coalesce("muscle_groups", F.array().cast("array<string>")))
        .withColumn("met", F.coalesce("met", F.lit(default_met)))
    )


def unmapped_exercises(sets: DataFrame, dim: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Exercises without muscles, with the number of sets that name them."""
    mapped = dim.filter(F.size("muscle_groups") > 0).select("exercise")
    counts = sets.groupBy(*keys, "exercise").agg(F.count("*").alias("n_sets"))
    return counts.join(mapped, "exercise", "left_anti").select(*keys, "exercise", "n_sets")
