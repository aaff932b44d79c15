"""Last-write-wins and the wide view of a long series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import DAY


def last_write_wins(rows: DataFrame, keys: Sequence[str], order: str = "seq") -> DataFrame:
    """The row with the highest ``order`` of each key, as one partially aggregated group."""
    rest = [c for c in rows.columns if c not in keys and c != order]
    if len(rest) == 1:
        picked = F.max_by(rest[0], order).alias(rest[0])
        return rows.groupBy(*keys).agg(picked, F.max(order).alias(order)).select(*rows.columns)
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"), F.max(order).alias(order))
    return best.select(*keys, "_row.*", order).select(*rows.columns)


def first_row(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the lowest ``order`` of each key."""
    rest = [c for c in rows.columns if c not in keys and c != order]
    best = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_row"), F.min(order).alias(order))
    return best.select(*keys, "_row.*", order).select(*rows.columns)


def pivot_latest(
    series: DataFrame,
    metrics: dict[str, Sequence[str]],
    keys: Sequence[str] = DAY,
    value: str = "value",
    order: str = "seq",
) -> DataFrame:
    """Wide table of the last value per key and metric: one aggregate, no second pass.

    ``metrics`` maps an output column to its accepted spellings, best first. The list is fixed, so
    no extra job looks for the distinct names; the buffers are numeric, so the aggregate hashes.
    """
    columns = []
    for name, spellings in metrics.items():
        found = [
            F.max_by(F.when(F.col("metric") == s, F.col(value)), F.when(F.col("metric") == s, F.col(order)))
            for s in spellings
        ]
        columns.append(F.coalesce(*found).alias(name))
    return series.groupBy(*keys).agg(*columns)
