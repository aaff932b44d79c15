"""Ingest jobs: wearable documents, legacy documents and set logs into the stored tables."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DAY, LOG_ROW, SERIES, SETS, WORKOUTS
from ..sources.readers import read_daily_store, read_set_log, read_wearable_docs
from ..sources.setlog import parse_set_log, split_log, unreadable_log_rows
from ..sources.snapshots import drop_folder
from ..sources.store import ONE_DAY, WHOLE, Merge, first_source_wins, merge_into, new_wins
from ..sources.wearable import flatten_documents
from .paths import Store

LOOKBACK_DAYS = 7
SET_ORDER = [*DAY, "pos"]


def store_series(series: DataFrame, store: Store, merge: Merge = new_wins) -> None:
    """Replace the days of ``series`` in the store; partitions are days, so a re-fetch writes only its own."""
    merge_into(series, store.series, SERIES, merge, [*DAY, "metric"], ONE_DAY)


def within_lookback(series: DataFrame, run_date: datetime.date, days: int = LOOKBACK_DAYS) -> DataFrame:
    """The trailing days a run may revise; older days are final."""
    return series.filter(F.col("date") > F.lit(run_date - datetime.timedelta(days=days)))


def ingest_wearable(
    spark: SparkSession, path: str | Sequence[str], store: Store, run_date: datetime.date | None = None
) -> DataFrame:
    """Landed wearable documents -> series store, new days replacing stored ones whole."""
    series = flatten_documents(read_wearable_docs(spark, path))
    if run_date is not None:
        series = within_lookback(series, run_date)
    store_series(series, store)
    return series


def migrate_legacy(
    spark: SparkSession, legacy_path: str | Sequence[str], store_path: str | None, store: Store
) -> DataFrame:
    """Legacy documents, overlaid by a date-keyed store if there is one, into the series store."""
    series = flatten_documents(read_wearable_docs(spark, legacy_path), qualified=True)
    if store_path is not None:
        series = new_wins(series, read_daily_store(spark, store_path))
    store_series(series, store)
    return series


def store_workouts(workouts: DataFrame, sets: DataFrame, store: Store) -> None:
    """Add days that are not stored yet; a day stays with the export that landed first. Sets go first: a
    run that stops between the two writes leaves days without a workout row, which the next run of the
    same batch adds."""
    merge_into(sets, store.sets, SETS, first_source_wins, SET_ORDER)
    merge_into(workouts, store.workouts, WORKOUTS, first_source_wins)


def store_log(rows: DataFrame, store: Store) -> None:
    """Text rows of exported logs -> workouts, sets and, for rows without a readable time, the quarantine table.

    A multi-line export cannot be split, so its text is parsed once: all steps read the rows written aside.
    """
    spark = rows.sparkSession
    aside = f"{store.sets}/_batches/{uuid.uuid4().hex}"
    rows.select(*(field.split()[0] for field in LOG_ROW.split(", "))).write.parquet(aside)
    try:
        kept = spark.read.schema(LOG_ROW).parquet(aside)
        store_workouts(*split_log(parse_set_log(kept)), store)
        merge_into(unreadable_log_rows(kept), f"{store.bad_rows}/log", LOG_ROW, same_rows_once, ["user_id", "source", "pos"], WHOLE)
    finally:
        drop_folder(spark, aside)


def same_rows_once(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of an export that was set aside before replace those rows, so a replay changes nothing."""
    return new_wins(stored, batch, ["user_id", "source"])


def ingest_set_log(spark: SparkSession, path: str | Sequence[str], store: Store) -> DataFrame:
    """Exported set logs -> workouts and sets, stored days staying as they are."""
    rows = read_set_log(spark, path)
    store_log(rows, store)
    return parse_set_log(rows)
