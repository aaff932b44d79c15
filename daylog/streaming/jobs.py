"""Streams over landed files. Each run takes what is new (``availableNow``) and stops.

Merges are idempotent by key, so a batch that is replayed after a failure leaves the same tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import exact_sum
from ..plans.ingest import LOOKBACK_DAYS, store_log, store_series
from ..plans.paths import Store
from ..schemas import SET_LOG, WEARABLE_DOC
from ..session import shared_folder
from ..sources.readers import SOURCE, landed
from ..sources.store import last_source_wins
from ..sources.wearable import flatten_documents

WEEK, MONDAY_OFFSET, LATENESS = "7 days", "4 days", "7 days"


def _checkpoint(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{shared_folder(spark)}/daylog/{name}"


def wearable_stream(
    spark: SparkSession,
    path: str,
    store: Store,
    checkpoint: str | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    files_per_batch: int = 100_000,
) -> StreamingQuery:
    """New wearable documents -> series store. A document may revise only the trailing days before
    its own fetch date; its older days are late data and are dropped."""

    def merge(batch: DataFrame, _: int) -> None:
        fetched = F.to_date(F.substring("date_fetched", 1, 10))
        marked = batch.withColumns(
            {
                "at": F.concat_ws(" ", "date_fetched", "source_file"),
                "open_from": F.date_sub(fetched, lookback_days - 1),
            }
        )
        # The document fetched last wins a day, in whichever batch it comes.
        store_series(flatten_documents(marked, order="at", not_before="open_from"), store, last_source_wins)

    documents = (
        spark.readStream.schema(f"user_id bigint, {WEARABLE_DOC}")
        .option("multiLine", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
        .withColumn("source_file", F.col("_metadata.file_path"))
    )
    return (
        documents.writeStream.foreachBatch(merge)
        .option("checkpointLocation", _checkpoint(spark, "wearable", checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def set_log_stream(
    spark: SparkSession, path: str, store: Store, checkpoint: str | None = None, files_per_batch: int = 100_000
) -> StreamingQuery:
    """New set-log exports -> workouts and sets; stored days are immutable."""

    def merge(batch: DataFrame, _: int) -> None:
        store_log(batch.withColumn("pos", F.monotonically_increasing_id()), store)

    rows = (
        spark.readStream.schema(f"{SET_LOG}, user_id bigint")
        .option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(path)
        .withColumn(SOURCE, landed())
    )
    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", _checkpoint(spark, "set_log", checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def weekly_totals(events: DataFrame, ts: str = "ts", keys: tuple[str, ...] = ("user_id",), value: str = "value") -> DataFrame:
    """Calendar-week counts and sums, Monday to Sunday, of a stream or a batch of timed rows."""
    rows = events.withWatermark(ts, LATENESS) if events.isStreaming else events
    weeks = rows.groupBy(F.window(ts, WEEK, WEEK, MONDAY_OFFSET), *keys).agg(
        F.count("*").alias("n"), exact_sum(F.col(value)).alias("total")
    )
    return weeks.select(F.col("window.start").cast("date").alias("week"), *keys, "n", "total")


def weekly_totals_stream(
    spark: SparkSession, events: DataFrame, out: str, checkpoint: str | None = None, **columns
) -> StreamingQuery:
    """Closed weeks of a stream appended to Parquet."""
    return (
        weekly_totals(events, **columns)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", _checkpoint(spark, "weekly", checkpoint))
        .trigger(availableNow=True)
        .start()
    )


