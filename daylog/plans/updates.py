"""Jobs that follow what was ingested: each takes up the partitions that changed since it last ran.

The snapshot log of a table is the journal of its changes: a partition changed if the version in force is not the one a job
took up last. What a job has taken up is itself a snapshot log, put after the job's own writes. A run that dies before that
takes the same partitions up again, and all jobs give the same tables when run twice.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ..sources.snapshots import begin, commit, newest
from .daily import run_averages, run_combine, run_dashboard, run_feed_months, run_payload, run_weekly
from .paths import Store


@contextmanager
def changed_months(spark: SparkSession, store: Store, job: str, sources: Mapping[str, str]) -> Iterator[list[str]]:
    """The months (``yyyy-MM``) of ``sources`` (name -> table path) that changed since the job last came to its end.

    What is in force is noted before the job reads, so a change made meanwhile is taken up next time.
    """
    journal = begin(spark, store.journal(job))
    now = {f"{name}/{part}": version for name, path in sources.items() for part, version in newest(spark, path).partitions.items()}
    seen = dict(journal.partitions)
    changed = {k for k in now.keys() | seen.keys() if now.get(k) != seen.get(k)}
    yield sorted({k.partition("/")[2][:7] for k in changed})
    if changed:
        commit(spark, store.journal(job), journal, {k: now.get(k) for k in changed})


def run_updates(spark: SparkSession, store: Store, day: datetime.date, dim: DataFrame | None = None, dashboard_dim: DataFrame | None = None) -> list[str]:
    """Bring days, averages, feed, dashboard, weeks and the payload of ``day`` up to date with every ingest so far.

    Returns the months whose days were made anew. ``dim`` is the exercise table; a new one asks for ``run_combine`` over
    all months.
    """
    with changed_months(spark, store, "combine", {"series": store.series, "workouts": store.workouts, "sets": store.sets}) as months:
        if months:
            run_combine(spark, store, dim, months=months)
    with changed_months(spark, store, "derive", {"daily": store.daily, "training_sets": store.training_sets}) as derived:
        if derived:
            run_averages(spark, store, derived)
            run_feed_months(spark, store, derived)
            run_dashboard(spark, store, dashboard_dim, derived)
            run_weekly(spark, store, derived)
    run_payload(spark, store, day)
    return months
