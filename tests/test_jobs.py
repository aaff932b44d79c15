import datetime
import json

from pyspark.sql import functions as F

from daylog.plans import daily as jobs
from daylog.plans import rendering
from daylog.plans.ingest import ingest_set_log, ingest_wearable
from daylog.plans.paths import Store
from daylog.session import shared_folder
from daylog.schemas import BAD_PLAN_ROW, FEED
from daylog.sources.store import current_folder, load_audit, manifest, preview, read_flat, read_table

from .conftest import rows
from .test_sources import CSV, DOC


def test_daily_run_from_landed_files_to_feed(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    ingest_wearable(spark, put("docs", 1, "a.json", DOC), store)
    ingest_set_log(spark, put("log", 1, "log.csv", CSV), store)
    jobs.run_combine(spark, store)
    jobs.run_combine(spark, store)  # a second run replaces the same months
    combined = jobs.load_combined(spark, store)
    assert combined.daily.count() == 4 and combined.sets.count() == 4
    squat = combined.sets.filter("exercise = 'Squat (Barbell)'").first()
    assert (squat.weight_lbs, squat.raw_weight_lbs, squat.muscle_groups) == (145.0, 50.0, ["Quads", "Glutes", "Hamstrings"])
    assert combined.sets.filter("exercise = 'Pull Up'").first().weight_lbs == 160.0
    jobs.run_averages(spark, store)
    assert read_flat(spark, store.averages).first().avg_steps == 175.0
    jobs.run_payload(spark, store, datetime.date(2025, 10, 10))
    payload = read_flat(spark, store.payload).first()
    assert [w.date for w in payload.recent_workouts] == ["2025-10-10", "2025-10-09"]
    assert payload.week_volume["back"] == 1
    jobs.run_feed(spark, store, datetime.date(2025, 10, 9), datetime.date(2025, 10, 10))
    feed = read_table(spark, store.feed, FEED)
    text = feed.filter((F.col("metric_type") == "Workout") & (F.col("date") == "2025-10-09")).first().value
    assert text == (
        'Squat (Barbell)\n"slow, "deep"\nand steady"\nSet 1: 145 lbs x 5\n\nPull Up\nSet 1: 160 lbs x None\n\n'
        "Curl\nSet 1: 20 lbs x 12"
    )


def test_combine_of_one_month_leaves_the_others(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    ingest_wearable(spark, put("docs", 1, "a.json", DOC), store)
    ingest_set_log(spark, put("log", 1, "log.csv", CSV), store)
    jobs.run_combine(spark, store)
    before = manifest(spark, store.daily)
    jobs.run_combine(spark, store, months=["2025-10"])
    after = manifest(spark, store.daily)
    assert after["2025-01"] == before["2025-01"] and after["2025-10"] != before["2025-10"]
    assert jobs.load_combined(spark, store).daily.count() == 4


def test_checks_are_stored(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    ingest_wearable(spark, put("docs", 1, "a.json", DOC), store)
    ingest_set_log(spark, put("log", 1, "log.csv", CSV.replace("Pull Up", "Juggling")), store)
    jobs.run_checks(spark, store)
    counts = {n: read_flat(spark, f"{store.bad_rows}/{n}").count() for n in ("series", "sets", "exercises")}
    # "Curl" and "Juggling" are in no table; one set has an unreadable weight.
    assert counts == {"series": 0, "sets": 1, "exercises": 2}


def answers(spark, *rows_of):
    text = "user_id bigint, date string, landed string, text string"
    return spark.createDataFrame([(u, d, at, focus and json.dumps({"day_focus": focus})) for u, d, at, focus in rows_of], text)


def test_plan_history_keeps_the_answer_that_landed_last(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    # The earlier answer has the larger text, and the batches come in the wrong order.
    first = answers(spark, (1, "2025-03-01", "09:00", "Zzz Push"), (1, "2025-03-01", "10:00", "Pull"), (1, "2025-04-02", "08:00", "Legs"))
    rendering.store_plans(first, store)
    rendering.store_plans(answers(spark, (1, "2025-03-01", "08:00", "Old"), (3, "2025-03-05", "08:00", "Rest"), (2, "2025-03-05", "1", None)), store)
    rendering.store_plans(first, store)  # a replay changes nothing
    rendering.store_plans(answers(spark, (None, "2025-03-05", "1", "Nobody"), (4, None, "1", "Never")), store)
    plans = rendering.plan_history(spark, store).orderBy("user_id", "date").collect()
    assert [(p.user_id, p.date.isoformat(), p.landed, p.plan.day_focus) for p in plans] == [
        (1, "2025-03-01", "10:00", "Pull"), (1, "2025-04-02", "08:00", "Legs"), (3, "2025-03-05", "08:00", "Rest")
    ]
    assert "Pull" in plans[0].workout_html and "Pull" in plans[0].card_html
    newest = {p.user_id: p.plan.day_focus for p in rendering.latest_plans(spark, store).collect()}
    assert newest == {1: "Legs", 3: "Rest"}
    early = rendering.latest_plans(spark, store, datetime.date(2025, 3, 31)).collect()
    assert {p.user_id: p.plan.day_focus for p in early} == {1: "Pull", 3: "Rest"}
    bad = read_table(spark, f"{store.bad_rows}/plans", BAD_PLAN_ROW, "whole").collect()
    assert sorted(str(r.user_id) for r in bad) == ["2", "4", "None"]


def test_answers_that_land_at_once_are_decided_alike(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    for order in (("A", "B"), ("B", "A")):
        rendering.store_plans(answers(spark, *((1, "2025-03-01", "1", x) for x in order)), store)
    assert rendering.latest_plans(spark, store).first().plan.day_focus == "B"


def test_missing_metrics_may_stay_null(spark):
    series = spark.createDataFrame(
        [(1, datetime.date(2025, 1, 1), "steps", 5.0, 1)], "user_id bigint, date date, metric string, value double, seq bigint"
    )
    assert jobs.wearable_days(series).first().distance == 0.0
    first = jobs.wearable_days(series, missing_as_null=True).first()
    assert (first.steps, first.distance, first.sleep_hours) == (5, None, None)


def test_runs_on_empty_stores(spark, tmp_path):
    store = Store(str(tmp_path / "empty"))
    series = spark.createDataFrame([], "user_id bigint, date date, metric string, value double, seq bigint")
    assert jobs.wearable_days(series).count() == 0
    jobs.run_combine(spark, store)


def test_audit_and_preview(spark):
    frame = spark.createDataFrame(
        [(1, datetime.date(2025, 1, d)) for d in range(1, 9) for _ in range(2)], "user_id bigint, date date"
    )
    audit = load_audit(frame, "t").first()
    assert (audit.n_rows, audit.n_users, audit.n_days, audit.first_date.day, audit.last_date.day) == (16, 1, 8, 1, 8)
    assert [d.day for _, d, _, _ in rows(preview(frame).filter("end = 'tail'"), "place")] == [8, 7, 6, 5, 4]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_feeds_of_single_days_add_up(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    points = [{"dateTime": f"2025-{m:02d}-{d:02d}", "value": str(100 * d)} for m, d in ((1, 30), (1, 31), (2, 1), (2, 3))]
    ingest_wearable(spark, put("docs", 1, "a.json", {"date_fetched": "2025-02-04", "time_series": {"steps": points}, "sleep": []}), store)
    jobs.run_combine(spark, store)

    def days():
        return [r.date.isoformat() for r in read_table(spark, store.feed, FEED).select("date").distinct().orderBy("date").collect()]

    jobs.run_feed(spark, store, datetime.date(2025, 1, 30), datetime.date(2025, 1, 30))
    jobs.run_feed(spark, store, datetime.date(2025, 2, 3), datetime.date(2025, 2, 3))
    assert days() == ["2025-01-30", "2025-02-03"]
    for _ in range(2):
        jobs.run_feed(spark, store, datetime.date(2025, 1, 31), datetime.date(2025, 2, 2))
        assert days() == ["2025-01-30", "2025-01-31", "2025-02-01", "2025-02-03"]
    assert [r.date.isoformat() for r in read_flat(spark, store.missing_days).collect()] == ["2025-02-02"]


def test_date_ranges_prune_months(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    ingest_wearable(spark, put("docs", 1, "a.json", DOC), store)
    ingest_set_log(spark, put("log", 1, "log.csv", CSV), store)
    jobs.run_combine(spark, store)
    assert len(manifest(spark, store.daily)) > 1
    combined, day = jobs.load_combined(spark, store), datetime.date(2025, 10, 10)
    for frame in (jobs.feed_of_day(combined, day), jobs.week_volume(combined.sets, day), jobs.prior_day(combined.daily, day)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "FileScan" in line]
        assert scans and all("PartitionFilters: [isnotnull(month" in line for line in scans), plan


def test_dashboard_weekly_and_documents_are_stored(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    ingest_wearable(spark, put("docs", 1, "a.json", DOC), store)
    ingest_set_log(spark, put("log", 1, "log.csv", CSV), store)
    jobs.run_combine(spark, store)
    jobs.run_dashboard(spark, store)
    assert sum(1 for _ in (tmp_path / "store/dashboard").rglob("*.parquet")) >= 2
    jobs.run_weekly(spark, store)
    for name in ("sets", "sets_trailing", "weight_ranked", "progress"):
        assert read_flat(spark, f"{store.weekly}/{name}").columns[:2] == ["user_id", "week"]
    assert read_flat(spark, f"{store.weekly}/sets").count() > 0
    jobs.run_averages(spark, store)
    jobs.run_payload(spark, store, datetime.date(2025, 10, 11), until=datetime.date(2025, 10, 9))
    assert [w.date for w in read_flat(spark, store.payload).first().recent_workouts] == ["2025-10-09"]
    assert "date_for_plan" in spark.read.text(current_folder(spark, f"{store.documents}/payload")).first().value
    assert "avg_steps" in spark.read.text(current_folder(spark, f"{store.documents}/averages")).first().value
    assert read_flat(spark, f"{store.documents}/averages_text").count() > 0


def test_payload_ranks_stored_summaries_of_touched_months(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    ingest_wearable(spark, put("docs", 1, "a.json", DOC), store)
    ingest_set_log(spark, put("log", 1, "log.csv", CSV), store)
    jobs.run_combine(spark, store)
    day = datetime.date(2025, 10, 10)
    jobs.run_payload(spark, store, day)
    combined = jobs.load_combined(spark, store)
    fresh = jobs.build_payload(combined, day)
    assert rows(read_flat(spark, store.payload).select("user_id", F.to_json(F.struct("*")))) == rows(fresh.select("user_id", F.to_json(F.struct("*"))))
    before = manifest(spark, store.summaries)
    more = CSV.replace("9 Oct 2025", "3 Nov 2025").replace("10 Oct 2025", "4 Nov 2025")
    ingest_set_log(spark, put("log", 1, "more.csv", more), store)
    jobs.run_combine(spark, store, months=["2025-11"])
    after = manifest(spark, store.summaries)
    assert after["2025-10"] == before["2025-10"] and "2025-11" in after
    jobs.run_payload(spark, store, datetime.date(2025, 11, 5))
    assert [w.date for w in read_flat(spark, store.payload).first().recent_workouts] == ["2025-11-04", "2025-11-03", "2025-10-10"]
