"""Incremental jobs against the same figures over the whole history."""

import datetime
import json
import random

import pytest
from pyspark.sql import functions as F

from daylog.operators.coach import day_summaries, newest_state, newest_summaries
from daylog.operators.month_parts import averages_of, merged, month_parts, reference_lines_of, user_means_of, valid_ranges_of
from daylog.operators.trends import averages, reference_lines, valid_ranges, with_user_means
from daylog.operators.weeks import weekly_progress, weekly_sets, weekly_weight_ranked
from daylog.plans import daily as jobs
from daylog.plans.ingest import ingest_set_log, ingest_wearable
from daylog.plans.paths import Store
from daylog.plans.updates import changed_months, run_updates
from daylog.schemas import DAILY, FEED, SUMMARIES
from daylog.sources.snapshots import newest
from daylog.sources.store import WHOLE, manifest, read_flat, read_table

from .conftest import rows
from .test_sources import CSV, export

DAY = datetime.date(2025, 6, 30)


def document(days, steps=1000, fetched="2025-07-01"):
    points = [{"dateTime": d.isoformat(), "value": str(steps + i)} for i, d in enumerate(days)]
    heart = [{"dateTime": d.isoformat(), "value": {"restingHeartRate": 50 + i % 9}} for i, d in enumerate(days)]
    nights = [{"dateOfSleep": d.isoformat(), "duration": 25_000_000 + 1_000 * i, "efficiency": 90} for i, d in enumerate(days)]
    return {"date_fetched": fetched, "time_series": {"steps": points, "heart": heart, "calories_out": points}, "sleep": nights}


def span(first, n, step=1):
    return [datetime.date.fromisoformat(first) + datetime.timedelta(days=i * step) for i in range(n)]


def daily(spark, n=400, seed=1):
    rng = random.Random(seed)
    out = []
    for user in (1, 2):
        for d in span("2024-01-05", n):
            if rng.random() < 0.8:
                out.append((user, d, rng.choice([0, rng.randint(1, 20000)]), 1.5, rng.choice([0, 50, 2400]), rng.choice([0.0, rng.random() * 9]),
                            None, None, rng.choice(["0:00", "1:05", "0:45"]), 0, rng.choice([0, 7]), rng.choice([0, 58]), 80.0))
    return spark.createDataFrame([*out, (3, span("2024-02-01", 1)[0], 0, 0.0, 0, 0.0, None, None, "0:00", 0, 0, 0, 0.0)], DAILY)


def test_merged_month_parts_equal_one_pass(spark):
    days = daily(spark)
    parts = month_parts(days)
    assert parts.count() > 20
    users = merged(parts)
    assert rows(averages_of(users), "user_id") == rows(averages(days), "user_id")
    charted = days.withColumn("total_calories", F.col("total_calories_burned"))
    assert rows(reference_lines_of(users), "user_id") == rows(reference_lines(charted), "user_id")
    assert rows(valid_ranges_of(users), "user_id") == rows(valid_ranges(charted), "user_id")
    overall = with_user_means(charted).select("user_id", "steps_total_average", "sleep_hours_total_average", "total_calories_total_average").distinct()
    assert rows(user_means_of(users), "user_id") == rows(overall, "user_id")


def test_weeks_of_a_month_include_those_that_straddle_it():
    found = [d.isoformat() for d in jobs.weeks_of(["2025-02"])]
    assert found == ["2025-01-27", "2025-02-03", "2025-02-10", "2025-02-17", "2025-02-24"]


def state(spark, **days):
    text = "user_id bigint, date date, summary string"
    return spark.createDataFrame([(int(u[1:]), d, f"{u} {d}") for u, dd in days.items() for d in dd], text)


def test_newest_state_takes_in_months_and_names_users_it_cannot_tell(spark):
    jan, feb, mar = span("2025-01-01", 10), span("2025-02-01", 3), span("2025-03-01", 4)
    stored = state(spark, u1=[*mar, *feb, jan[9]], u2=feb)  # user 1 holds 8 rows, user 2 all it has
    months = ["2025-03"]
    kept, short = newest_state(stored, state(spark, u1=mar[:1], u3=mar), months, keep=8)
    assert rows(short) == [(1,)]
    got = {u: sorted(r.date for r in kept.filter(F.col("user_id") == u).collect()) for u in (2, 3)}
    assert got == {2: feb, 3: mar}
    kept, short = newest_state(stored, state(spark, u1=[*mar, *span("2025-03-20", 2)], u2=jan[:2]), ["2025-03"], keep=8)
    assert rows(short) == [] and len(rows(kept.filter("user_id = 1"))) == 8
    assert min(r.date for r in kept.filter("user_id = 1").collect()) == feb[1]
    # A changed month older than the state brings rows that the state cannot place.
    kept, short = newest_state(stored, state(spark, u1=span("2024-12-01", 5)), ["2024-12"], keep=8)
    assert rows(short) == [] and min(r.date for r in kept.filter("user_id = 1").collect()) == jan[9]


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """One store for all tests of the module, which only add to it. Its many small plans are not worth compiling."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    root = tmp_path_factory.mktemp("updates")

    def landed(kind, user, content):
        folder = root / kind / f"user_id={user}"
        folder.mkdir(parents=True)
        (folder / ("a.csv" if kind == "log" else "a.json")).write_text(content if kind == "log" else json.dumps(content))
        return str(root / kind)

    store = Store(str(root / "store"))
    landed("docs", 1, document(span("2025-01-20", 80)))
    ingest_wearable(spark, landed("docs", 2, document(span("2025-01-03", 12, 13))), store)
    ingest_set_log(spark, landed("log", 1, CSV), store)
    run_updates(spark, store, DAY)
    yield store
    spark.conf.unset("spark.sql.codegen.wholeStage")


def whole(spark, store):
    """Every derived table from the whole stored history."""
    combined = jobs.load_combined(spark, store)
    dim = jobs.checked_broadcast(jobs.exercise_dim(spark, 2))
    return {
        "averages": rows(averages(combined.daily), "user_id"),
        "dashboard": rows(jobs.dashboard(jobs.Combined(combined.daily, combined.sets), dim), "user_id", "date"),
        "feed": sorted(map(tuple, jobs.feed_of_all(combined).collect())),
        "weeks": sorted(map(tuple, weekly_sets(combined.sets).collect())),
        "ranked": sorted(map(tuple, weekly_weight_ranked(combined.sets).collect())),
        "progress": sorted(map(tuple, weekly_progress(combined.sets).collect())),
        "recent": sorted((r.user_id, r.date) for r in newest_summaries(day_summaries(combined.sets)).collect()),
    }


def stored(spark, store):
    names = jobs.dashboard(jobs.load_combined(spark, store), jobs.exercise_dim(spark, 2)).columns
    return {
        "averages": rows(read_flat(spark, store.averages), "user_id"),
        "dashboard": rows(jobs.load_dashboard(spark, store).select(names), "user_id", "date"),
        "feed": sorted(map(tuple, read_table(spark, store.feed, FEED).drop("month").collect())),
        "weeks": sorted(map(tuple, read_flat(spark, f"{store.weekly}/sets").collect())),
        "ranked": sorted(map(tuple, read_flat(spark, f"{store.weekly}/weight_ranked").collect())),
        "progress": sorted(map(tuple, read_flat(spark, f"{store.weekly}/progress").collect())),
        "recent": sorted((r.user_id, r.date) for r in read_table(spark, store.recent, SUMMARIES, WHOLE).collect()),
    }


def test_a_payload_reads_no_older_summaries(spark, filled, monkeypatch):
    asked = []
    read = jobs.read_table
    monkeypatch.setattr(jobs, "read_table", lambda spark, path, *a, **k: asked.append(path) or read(spark, path, *a, **k))
    jobs.run_payload(spark, filled, DAY)
    assert filled.recent in asked and filled.summaries not in asked
    payload = read_flat(spark, filled.payload).filter("user_id = 1").first()
    monkeypatch.undo()
    fresh = jobs.build_payload(jobs.load_combined(spark, filled), DAY).filter("user_id = 1").first()
    assert payload == fresh


def test_averages_read_touched_months_only(spark, filled, monkeypatch):
    asked = []
    read = jobs.read_table
    monkeypatch.setattr(jobs, "read_table", lambda spark, path, schema, by="month", parts=None, **k: asked.append((path, parts)) or read(spark, path, schema, by, parts, **k))
    jobs.run_averages(spark, filled, ["2025-02"])
    assert [parts for path, parts in asked if path == filled.daily] == [["2025-02"]]
    assert newest(spark, filled.averages).number == 2


def test_a_late_day_reaches_every_table_without_naming_months(spark, put, filled):
    assert stored(spark, filled) == whole(spark, filled)
    before = {name: manifest(spark, getattr(filled, name)) for name in ("daily", "feed", "dashboard", "month_parts", "summaries", "weeks")}
    ingest_wearable(spark, put("late", 1, "b.json", document(span("2025-02-10", 1), 77, "2025-07-02")), filled)
    ingest_set_log(spark, put("late_log", 1, "more.csv", export((1, "New", "Squat", 5)).replace("Oct 2025", "Feb 2025")), filled)
    assert run_updates(spark, filled, DAY) == ["2025-02"]
    assert stored(spark, filled) == whole(spark, filled)
    after = {name: manifest(spark, getattr(filled, name)) for name in before}
    for name in ("daily", "feed", "month_parts", "summaries"):
        assert {m for m in after[name] if after[name][m] != before[name].get(m)} == {"2025-02"}
    assert {w for w in after["weeks"] if after["weeks"][w] != before["weeks"].get(w)} == {"2025-01-27"}  # 1 February is a Saturday
    moved = {m for m in after["dashboard"] if after["dashboard"][m] != before["dashboard"].get(m)}
    assert "2025-02" in moved and "2025-01" not in moved and "2025-10" not in moved
    assert run_updates(spark, filled, DAY) == []


def test_a_run_that_dies_takes_its_months_up_again(spark, put, filled):
    ingest_wearable(spark, put("late", 2, "b.json", document(span("2025-03-10", 2), 5, "2025-07-02")), filled)
    sources = {"series": filled.series}
    with pytest.raises(RuntimeError):
        with changed_months(spark, filled, "combine", sources | {"workouts": filled.workouts, "sets": filled.sets}) as months:
            assert months == ["2025-03"]
            raise RuntimeError("the driver dies here")
    assert run_updates(spark, filled, DAY) == ["2025-03"]
    assert stored(spark, filled) == whole(spark, filled)
