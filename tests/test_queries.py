"""Every query against its SQL, and the shape of the plans."""

import datetime
import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from workload.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
ORACLE = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.date().isoformat() if value.time() == datetime.time() else value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def table(names, records):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = QUERIES[name](spark, SMALL)
    found = duck.execute(ORACLE[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(frame.columns)
    assert table(frame.columns, frame.collect()) == table(names, found.fetchall())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0


def executed(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"load_audit_sets"}))
def test_plan_has_no_python_no_cross_join_and_no_single_task(spark, name):
    plan = executed(QUERIES[name](spark, SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in plan, bad


def lineitem_scans(plan):
    return len(re.findall(r"FileScan parquet \[l_", plan))


@pytest.mark.parametrize("name, scans", [("workout_text", 1), ("workout_focus", 1), ("weekly_sets", 1), ("recent_workouts", 3)])
def test_sets_are_read_as_few_times_as_needed(spark, name, scans):
    frame = QUERIES[name](spark, SMALL)
    frame.collect()
    final = executed(frame).split("== Initial Plan ==")[0]
    assert lineitem_scans(final) <= scans


def test_scans_read_only_needed_columns(spark):
    plan = executed(QUERIES["weekly_sets"](spark, SMALL))
    scan = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan).group(1)
    assert {c.split("#")[0] for c in scan.split(",")} <= {"l_orderkey", "l_partkey", "l_tax", "l_discount", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"}


@pytest.mark.parametrize("name", ["workout_notes", "recent_workouts", "date_preview"])
def test_top_rows_are_limited_before_the_shuffle(spark, name):
    plan = executed(QUERIES[name](spark, SMALL))
    assert re.search(r"WindowGroupLimit .*Partial", plan)


def test_dimensions_are_broadcast_and_raw_sets_are_reduced_before_the_shuffle(spark):
    plan = executed(QUERIES["workout_calories_day"](spark, SMALL))
    assert "BroadcastHashJoin [exercise" in plan
    above = plan[: plan.index("BroadcastHashJoin [exercise")]
    assert above.index("Exchange hashpartitioning") < above.index("partial_sum")


def test_the_week_is_filtered_below_the_join(spark):
    plan = executed(QUERIES["week_volume"](spark, SMALL))
    below = plan[plan.index("Join [l_orderkey") :]
    assert re.search(r"Filter .*date_add\(2023-11-20[^>]*>= 2024-01-15", below)
