"""Top rows of a group and exact positions in groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Positions of one block: the most that one task has to order at a time is what shares a block.
BLOCK_BITS = 13


def with_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows that have all their keys. Stating it once at the base keeps joins from adding the test to
    one of two branches, which would stop Spark from sharing their shuffle."""
    for key in keys:
        rows = rows.filter(F.col(key).isNotNull())
    return rows


def position_block() -> Column:
    """A block key that spans 8,192 positions. Blocks are ranges of the one order of sets, position
    first, so numbering by blocks gives the same numbers as ordering a whole group."""
    return F.shiftright(F.col("pos").cast("bigint"), BLOCK_BITS)


def top_rows(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows per group. Spark limits each group before the shuffle, so a hot group sends
    at most ``n`` rows from every task."""
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)


def number_rows(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str, block: str = "block"
) -> DataFrame:
    """Number rows 1..n within each group without ordering a whole group in one task.

    ``block`` rises with ``order``. Rows are numbered inside (group, block); the block sizes, a far
    smaller table, give each block its start; both meet again on (group, block).
    """
    cell = [*group, block]
    numbered = rows.withColumn("_local", F.row_number().over(Window.partitionBy(*cell).orderBy(*order)))
    before = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(*cell)
        .agg(F.count("*").alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(before), F.lit(0)))
        .drop("_size")
    )
    return numbered.join(starts, cell).withColumn(name, F.col("_start") + F.col("_local")).drop("_local", "_start")
