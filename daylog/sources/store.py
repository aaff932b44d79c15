"""Stored tables: versioned Parquet partitions behind a snapshot log, upserts, and JSON egress.

Parquet has no MERGE. A table is a folder of partitions, ``version=V/month=M`` (or ``day=D``), and a log whose newest
entry names the version in force of every partition (``snapshots``). An upsert reads the partitions its batch touches, writes
them anew under a new version, and then puts the next entry. Until that step readers see the old rows, after it the new
ones; a run that dies in between leaves files that nothing points to and can be run again. Nothing that is read is ever
overwritten. Two jobs may write one table: a merge that meets another writer's change of its partitions starts again on it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_key
from ..operators.ranking import top_rows
from ..schemas import DAY
from .snapshots import VERSION, ConcurrentWrite, Snapshot, begin, commit, drop_folder, names_in, newest

MONTH, ONE_DAY, WHOLE = "month", "day", "whole"
#: Name of the one partition of a table without days.
ALL = "all"
#: Times a merge is done anew when another writer was faster.
MERGES = 3


def partition_key(by: str, date: Column) -> Column:
    """The partition of a date: its month ``yyyy-MM``, the day itself as text, or the one of a table without days."""
    if by == WHOLE:
        return F.lit(ALL)
    return month_key(date) if by == MONTH else date.cast("string")


def manifest(spark: SparkSession, path: str) -> dict[str, str]:
    """Version in force of each partition; empty when nothing is stored."""
    return dict(newest(spark, path).partitions)


def read_table(
    spark: SparkSession,
    path: str,
    schema: str,
    by: str = MONTH,
    partitions: Sequence[str] | None = None,
    snapshot: Snapshot | None = None,
) -> DataFrame:
    """The rows in force, with their partition column, so that filters on it prune folders.

    ``partitions`` narrows it further: other folders are not even listed. ``snapshot`` is the entry to read, the newest one
    if none is given.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    held = (snapshot or newest(spark, path)).partitions
    chosen = sorted(held if partitions is None else set(partitions) & set(held))
    if not chosen:
        return spark.createDataFrame([], f"{schema}, {by} string")
    folders = [f"{path}/{VERSION}={held[x]}/{by}={x}" for x in chosen]
    rows = spark.read.schema(f"{schema}, {VERSION} string, {by} string").option("basePath", path).parquet(*folders)
    return rows.select(*names, by)


def write_partitions(
    rows: DataFrame,
    path: str,
    order: Sequence[str] = DAY,
    by: str = MONTH,
    replaced: Sequence[str] | None = (),
    base: Snapshot | None = None,
) -> None:
    """Replace the partitions present in ``rows``, and empty those of ``replaced`` that are not (None: all others).

    ``base`` is the entry that ``rows`` were made from. The rebalance hint lets adaptive execution split a large partition
    over many files and join small ones.
    """
    spark = rows.sparkSession
    base = base or begin(spark, path)
    version = uuid.uuid4().hex
    keyed = rows.drop(by).withColumn(by, partition_key(by, F.col("date")))
    folder = f"{path}/{VERSION}={version}"
    keyed.hint("rebalance", by).sortWithinPartitions(by, *order).write.partitionBy(by).parquet(folder)
    written = [name.partition("=")[2] for name in names_in(spark, folder) if name.startswith(f"{by}=")]
    emptied = set(base.partitions if replaced is None else replaced) & set(base.partitions)
    commit(spark, path, base, dict.fromkeys(emptied, None) | dict.fromkeys(written, version))


def write_table(rows: DataFrame, path: str, order: Sequence[str] = DAY) -> None:
    """Replace the months present in ``rows``."""
    write_partitions(rows, path, order)


def current_folder(spark: SparkSession, path: str) -> str | None:
    """Where the files in force of a table without partitions lie; None when nothing is stored."""
    held = newest(spark, path).partitions
    return f"{path}/{VERSION}={held[ALL]}" if held else None


def _replace_whole(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    base, version = begin(spark, path), uuid.uuid4().hex
    write(f"{path}/{VERSION}={version}")
    commit(spark, path, base, {ALL: version})


def write_flat(rows: DataFrame, path: str) -> None:
    """Replace a small table without dates, such as averages; readers see the old one until the new one is whole."""
    _replace_whole(rows.sparkSession, path, lambda folder: rows.write.parquet(folder))


def read_flat(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The rows in force of a table without dates. Without a ``schema`` the table must be there."""
    folder = current_folder(spark, path)
    if folder is None and schema is not None:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(folder or path)


def write_json(rows: DataFrame, path: str, order: Sequence[str] = DAY) -> None:
    """JSON egress, one line per row, in order within each file; the files in force lie in ``current_folder``."""
    _replace_whole(rows.sparkSession, path, lambda folder: rows.sortWithinPartitions(*order).write.json(folder))


def touched(batch: DataFrame, by: str = MONTH) -> list[str]:
    """Partitions of a batch: a list bounded by the calendar, used to read only those of the stored table."""
    rows = batch.select(partition_key(by, F.col("date")).alias(by)).distinct().collect()
    return sorted(row[by] for row in rows if row[by] is not None)


def new_wins(stored: DataFrame, batch: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    """Whole-record upsert: a key of the batch replaces every stored row of that key."""
    replaced = batch.select(*keys).distinct()
    return stored.join(replaced, list(keys), "left_anti").unionByName(batch)


def stored_wins(stored: DataFrame, batch: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    """Insert-if-absent: rows of the batch whose key is stored are left out."""
    known = stored.select(*keys).distinct()
    return stored.unionByName(batch.join(known, list(keys), "left_anti"))


def _of_best_source(rows: DataFrame, pick) -> DataFrame:
    """Rows of the one source that wins their day; a row for each day is all that is shuffled besides."""
    best = rows.groupBy(*DAY).agg(pick("source").alias("source"))
    return rows.join(best, [*DAY, "source"], "left_semi")


def first_source(rows: DataFrame) -> DataFrame:
    """Of several exports that hold a day, the rows of the one that landed first."""
    return _of_best_source(rows, F.min)


def first_source_wins(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """A day belongs to the export that landed first, whichever batch brings it. A replay changes nothing."""
    known = stored.select(*DAY, "source").distinct()
    return first_source(stored.unionByName(batch.join(known, [*DAY, "source"], "left_anti")))


def last_source_wins(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """A day belongs to the document fetched last, whichever batch brings it. A replay changes nothing."""
    known = stored.select(*DAY, "source").distinct()
    return _of_best_source(stored.unionByName(batch.join(known, [*DAY, "source"], "left_anti")), F.max)


Merge = Callable[[DataFrame, DataFrame], DataFrame]


def merge_into(batch: DataFrame, path: str, schema: str, merge: Merge, order: Sequence[str] = DAY, by: str = MONTH) -> list[str]:
    """Merge a batch into a stored table, reading and writing only the partitions it touches; returns these.

    The batch itself is first written aside in the table's folder: it is used twice, and no executor's
    memory or disk has to keep it. Where another writer changed one of the partitions meanwhile, the merge starts again on
    what that one left.
    """
    spark = batch.sparkSession
    names = [field.split()[0] for field in schema.split(", ")]
    aside = f"{path}/_batches/{uuid.uuid4().hex}"
    batch.select(*names).write.parquet(aside)
    try:
        return merge_stored(spark.read.schema(schema).parquet(aside), path, schema, merge, order, by)
    finally:
        drop_folder(spark, aside)


def merge_stored(batch: DataFrame, path: str, schema: str, merge: Merge, order: Sequence[str] = DAY, by: str = MONTH) -> list[str]:
    """``merge_into`` for a batch that lies in files of its own already."""
    spark = batch.sparkSession
    parts = touched(batch, by)
    for left in range(MERGES - 1, -1, -1) if parts else ():
        base = begin(spark, path)
        stored = read_table(spark, path, schema, by, parts, base).drop(by)
        try:
            write_partitions(merge(stored, batch), path, order, by, base=base)
            break
        except ConcurrentWrite:
            if not left:
                raise
    return parts


def replace_range(rows: DataFrame, path: str, schema: str, first, last, order: Sequence[str] = DAY) -> None:
    """Replace the rows from ``first`` to ``last`` by ``rows``; other days of the same months stay."""
    spark = rows.sparkSession
    months = [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]
    names = [field.split()[0] for field in schema.split(", ")]
    base = begin(spark, path)
    stored = read_table(spark, path, schema, MONTH, months, base).drop(MONTH)
    others = stored.filter(~F.col("date").between(F.lit(first), F.lit(last)))
    write_partitions(others.unionByName(rows.select(*names)), path, order, MONTH, months, base)


def union_rows(*parts: DataFrame) -> DataFrame:
    """Concatenation of batches, duplicates kept."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def load_audit(rows: DataFrame, name: str) -> DataFrame:
    """Rows, users and user-days of a load as one row, from partial counts per user and day."""
    per_day = rows.groupBy(*DAY).agg(F.count("*").alias("n"))
    per_user = per_day.groupBy("user_id").agg(
        F.sum("n").alias("n"), F.count("*").alias("days"), F.min("date").alias("lo"), F.max("date").alias("hi")
    )
    return per_user.agg(
        F.lit(name).alias("table_name"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count("*").alias("n_users"),
        F.coalesce(F.sum("days"), F.lit(0)).alias("n_days"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
    )


def preview(rows: DataFrame, n: int = 5) -> DataFrame:
    """First and last ``n`` dates of each user with their place, for a log line."""
    days = rows.select(*DAY).distinct()
    head = top_rows(days, ["user_id"], [F.asc("date")], n, "place").withColumn("end", F.lit("head"))
    tail = top_rows(days, ["user_id"], [F.desc("date")], n, "place").withColumn("end", F.lit("tail"))
    return head.unionByName(tail)
