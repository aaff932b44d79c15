"""Readers of landed files and stored tables. One landed file is one user's document or export.

The user comes from a ``user_id=...`` directory, as Spark's partition discovery reads it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import iso_date
from ..schemas import COMBINED_DAY, COMBINED_SET, DAY, LEGACY_SET_DOC, SET_LOG, WEARABLE_DOC, WORKOUT_DOC

SOURCE_FILE = "source_file"
SOURCE = "source"


def landed() -> Column:
    """When and as what a row's file landed: texts of it rise in the order of landing, then of names."""
    time = F.date_format(F.col("_metadata.file_modification_time"), "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return F.concat_ws(" ", time, F.col("_metadata.file_path"))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored Parquet table, or an empty table of the schema when nothing is stored yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_required(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored Parquet table that must exist; Spark raises PATH_NOT_FOUND otherwise."""
    return spark.read.schema(schema).parquet(path)


def _with_user(documents: DataFrame) -> DataFrame:
    """Documents that lie outside a ``user_id=`` directory belong to user 0."""
    if "user_id" in documents.columns:
        return documents.withColumn("user_id", F.col("user_id").cast("bigint"))
    return documents.withColumn("user_id", F.lit(0).cast("bigint"))


def _json(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.schema(schema).option("multiLine", True).option("pathGlobFilter", "*.json")
    rows = reader.json(paths).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))
    return _with_user(rows)


def read_wearable_docs(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Wearable documents of a folder tree, with the file they came from."""
    return _json(spark, path, WEARABLE_DOC)


def read_date_map(spark: SparkSession, path: str, value_type: str = "map<string,string>") -> DataFrame:
    """Date-keyed documents ``{date: record}`` -> rows (user_id, date, record).

    A key that is no ISO date is skipped. Such a document is one user's store, so it is one row.
    """
    reader = spark.read.option("pathGlobFilter", "*.json")
    texts = _with_user(reader.text(path, wholetext=True))
    entries = texts.select("user_id", F.explode(F.from_json("value", f"map<string,{value_type}>")))
    dated = entries.select("user_id", iso_date(F.col("key")).alias("date"), F.col("value").alias("record"))
    return dated.filter(F.col("date").isNotNull())


def read_daily_store(spark: SparkSession, path: str) -> DataFrame:
    """Date-keyed wearable stores -> the long text series. Values that are objects stay JSON text."""
    days = read_date_map(spark, path)
    return days.select(*DAY, F.explode("record").alias("metric", "value")).withColumns(
        {"seq": F.lit(0).cast("bigint"), SOURCE: F.lit("")}
    )


def read_combined(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Date-keyed combined documents -> the daily table and the set table."""
    days = read_date_map(spark, path, COMBINED_DAY)
    return combined_daily(days), combined_sets(days)


def combined_daily(days: DataFrame) -> DataFrame:
    """Daily table of combined records, absent and null fields defaulted."""
    defaults = {
        "steps": F.lit(0),
        "distance": F.lit(0.0),
        "total_calories_burned": F.lit(0),
        "sleep_hours": F.lit(0.0),
        "total_workout_duration": F.lit("0:00"),
        "calories_burned_from_workout": F.lit(0),
        "calories_burned_from_steps": F.lit(0),
        "resting_heart_rate": F.lit(0),
        "bodyweight": F.lit(0.0),
    }
    fields = (
        "steps distance total_calories_burned sleep_hours sleep_score workout_title total_workout_duration "
        "calories_burned_from_workout calories_burned_from_steps resting_heart_rate bodyweight"
    ).split()
    chosen = [
        (F.coalesce(F.col(f"record.{f}"), defaults[f]) if f in defaults else F.col(f"record.{f}")).alias(f)
        for f in fields
    ]
    return days.select(*DAY, *chosen)


def combined_sets(days: DataFrame) -> DataFrame:
    """Flat sets of combined records in list order; entries that are null or nameless fall out."""
    entries = F.coalesce(F.col("record.exercises"), F.array().cast(f"array<{COMBINED_SET}>"))
    rows = days.select(*DAY, F.posexplode(entries).alias("pos", "set"))
    return rows.filter(F.col("set.exercise").isNotNull()).select(
        *DAY,
        F.col("pos").cast("bigint").alias("pos"),
        "set.exercise",
        "set.set_type",
        "set.weight_lbs",
        F.col("set.reps").cast("int").alias("reps"),
        "set.distance",
        F.coalesce("set.notes", F.lit("")).alias("notes"),
        F.coalesce("set.muscle_groups", F.array().cast("array<string>")).alias("muscle_groups"),
    )


def read_set_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Exported set logs, all text, quotes doubled inside quoted fields, with row order ``pos``.

    A multi-line export is read by one task, so the generated id rises with the lines of a file. It
    says nothing about the order of files; ``source`` does.
    """
    reader = (
        spark.read.schema(SET_LOG)
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("pathGlobFilter", "*.csv")
    )
    paths = [path] if isinstance(path, str) else list(path)
    rows = reader.csv(paths).withColumn("pos", F.monotonically_increasing_id())
    return _with_user(rows.withColumn(SOURCE, landed()))


def read_workout_docs(spark: SparkSession, path: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Workout documents (arrays of workouts) -> workouts and text sets.

    Files count in the order of their names, records of a file in their order; the record of a date that
    comes last replaces the others.
    """
    docs = _json(spark, path, WORKOUT_DOC).withColumn("seq", F.monotonically_increasing_id())
    records = docs.select(
        "user_id",
        iso_date(F.col("Date")).alias("date"),
        F.col("Workout_Title").alias("title"),
        F.coalesce("Workout_Duration", F.lit("0:00")).alias("duration"),
        "exercises",
        "seq",
        F.col(SOURCE_FILE).alias(SOURCE),
    ).filter(F.col("date").isNotNull())
    newest = records.groupBy(*DAY).agg(F.max(F.struct(SOURCE, "seq")).alias("last"))
    newest = newest.select(*DAY, "last.*")
    kept = records.join(newest, [*DAY, SOURCE, "seq"], "left_semi")
    sets = kept.select(*DAY, SOURCE, F.posexplode("exercises").alias("pos", "set"))
    flat = sets.select(*DAY, F.col("pos").cast("bigint").alias("pos"), "set.*", SOURCE)
    return kept.select(*DAY, "title", "duration", "seq", SOURCE), flat


def read_legacy_sets(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """First-version workout documents: one flat record per set, empty texts kept. ``pos`` orders the sets of
    a file, ``source`` the files."""
    rows = _json(spark, path, LEGACY_SET_DOC).withColumn("pos", F.monotonically_increasing_id())
    return rows.withColumn("date", iso_date(F.col("date"))).withColumnRenamed(SOURCE_FILE, SOURCE)


def read_json_docs(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """Payload or plan documents with a declared schema, one row per file."""
    return _json(spark, path, schema)


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files (templates, profiles), one row per file with its user."""
    texts = spark.read.text(path, wholetext=True)
    return _with_user(texts.withColumn(SOURCE_FILE, F.col("_metadata.file_path")).withColumnRenamed("value", "text"))
