import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from daylog.operators import days
from daylog.plans.ingest import ingest_set_log, ingest_wearable, migrate_legacy
from daylog.plans.paths import Store
from daylog.schemas import PLAN, SERIES, SETS, WORKOUTS
from daylog.sources import readers
from daylog.sources.setlog import legacy_log, parse_set_log, split_log, unreadable_log_rows
from daylog.sources import store as tables
from daylog.sources.snapshots import drop_old_versions
from daylog.sources.store import current_folder, manifest, merge_into, new_wins, read_table, stored_wins, touched, write_json, write_table
from daylog.sources.wearable import basic_series, flatten_documents

from .conftest import rows


def series_of(api, *points):
    return {api: [{"dateTime": d, "value": v} for d, v in points]}


DOC = {
    "date_fetched": "2025-01-03 08:00:00",
    "time_series": {
        "steps": series_of("activities-steps", ("2025-01-01", "100"), ("2025-01-02", "200"), ("2025-01-02", "250")),
        "distance": [{"dateTime": "2025-01-01", "value": "1.5"}],
        "heart": series_of("activities-heart", ("2025-01-01", {"restingHeartRate": 58, "zones": []}), ("2025-01-02", {"zones": []})),
        "active_minutes": {
            "very": series_of("activities-minutesVeryActive", ("2025-01-01", "30")),
            "light": series_of("activities-minutesLightlyActive", ("2025-01-01", "90")),
        },
    },
    "sleep": [
        {"dateOfSleep": "2025-01-02", "duration": 28800000, "efficiency": 90, "startTime": "a", "endTime": "b"},
        {"dateOfSleep": "2025-01-02", "duration": 3600000, "efficiency": 80, "startTime": "c", "endTime": "d"},
        {"dateOfSleep": "", "duration": 1, "efficiency": 1, "startTime": "x", "endTime": "y"},
        {"duration": 1, "efficiency": 1, "startTime": "x", "endTime": "y"},
    ],
}


def as_map(series):
    return {(r.user_id, r.date.isoformat(), r.metric): r.value for r in series.collect()}


def test_flatten_bare_names_and_last_values(spark, put):
    found = as_map(flatten_documents(readers.read_wearable_docs(spark, put("docs", 7, "a.json", DOC))))
    assert found[7, "2025-01-01", "steps"] == "100"
    assert found[7, "2025-01-02", "steps"] == "250"
    assert found[7, "2025-01-01", "distance"] == "1.5"
    assert found[7, "2025-01-01", "active_minutes_very"] == "30"
    assert found[7, "2025-01-01", "active_minutes_light"] == "90"
    assert found[7, "2025-01-02", "sleep_duration"] == "3600000"
    assert found[7, "2025-01-02", "sleep_efficiency"] == "80"
    assert found[7, "2025-01-02", "sleep_start"] == "c"
    assert len(found) == 11


def test_flatten_qualified_names(spark, put):
    found = as_map(flatten_documents(readers.read_wearable_docs(spark, put("docs", 7, "a.json", DOC)), qualified=True))
    assert found[7, "2025-01-01", "steps_activities-steps"] == "100"
    assert found[7, "2025-01-01", "active_minutes_very"] == "30"
    assert found[7, "2025-01-01", "distance"] == "1.5"


def test_later_document_replaces_the_day_whole(spark, put):
    put("docs", 1, "a.json", DOC)
    later = {"date_fetched": "2025-01-04 08:00:00", "time_series": {"steps": series_of("s", ("2025-01-01", "999"))}}
    docs = readers.read_wearable_docs(spark, put("docs", 1, "b.json", later))
    whole = as_map(flatten_documents(docs))
    assert {m for (_, d, m) in whole if d == "2025-01-01"} == {"steps"}
    by_metric = as_map(flatten_documents(docs, whole_days=False))
    assert by_metric[1, "2025-01-01", "steps"] == "999" and by_metric[1, "2025-01-01", "distance"] == "1.5"


def test_both_spellings_make_the_same_day(spark, put):
    docs = readers.read_wearable_docs(spark, put("docs", 7, "a.json", DOC))
    bare = days.wearable_days(days.typed_series(flatten_documents(docs)))
    qualified = days.wearable_days(days.typed_series(flatten_documents(docs, qualified=True)))
    assert rows(bare, "date") == rows(qualified, "date")
    first, second = bare.orderBy("date").collect()
    assert (first.steps, first.distance, first.resting_heart_rate, first.sleep_hours) == (100, 1.5, 58, 0.0)
    assert (second.steps, second.resting_heart_rate, second.sleep_hours, second.sleep_score) == (250, 0, 1.0, 80)


def test_qualified_spelling_wins(spark):
    series = spark.createDataFrame(
        [(1, "2025-01-01", "steps", "5", 9), (1, "2025-01-01", "steps_activities-steps", "6", 1)],
        "user_id bigint, date string, metric string, value string, seq bigint",
    ).withColumn("date", F.to_date("date"))
    assert days.wearable_days(days.typed_series(series)).first().steps == 6


def test_unreadable_values_are_set_aside(spark):
    series = spark.createDataFrame(
        [(1, "steps", "12.7"), (1, "steps", "12"), (1, "distance", "x"), (1, "weight", None), (1, "floors", "x")],
        "user_id bigint, metric string, value string",
    )
    assert rows(days.unreadable_values(series), "metric") == [(1, "distance", "x"), (1, "steps", "12.7")]


def test_basic_series(spark, put):
    docs = readers.read_wearable_docs(spark, put("docs", 7, "a.json", DOC))
    kept = basic_series(flatten_documents(docs, qualified=True))
    assert {r.metric for r in kept.collect()} == {"steps", "distance"}


STORE_DOC = {
    "2025-01-01": {"steps_activities-steps": "11", "heart_activities-heart": {"restingHeartRate": 50}, "sleep_duration": 3600000},
    "bad-key": {"steps_activities-steps": "99"},
}


def test_date_map_skips_bad_keys(spark, put):
    series = readers.read_daily_store(spark, put("store", 3, "s.json", STORE_DOC))
    day = days.wearable_days(days.typed_series(series)).collect()
    assert len(day) == 1
    assert (day[0].user_id, day[0].steps, day[0].resting_heart_rate, day[0].sleep_hours) == (3, 11, 50, 1.0)


def test_combined_document_becomes_daily_and_sets(spark, put):
    document = {
        "2025-01-01": {
            "steps": 5, "sleep_score": None, "total_workout_duration": "1:05",
            "exercises": [
                {"exercise": "Squat", "weight_lbs": 10.0, "reps": 5, "muscle_groups": ["Quads"], "notes": "n"},
                None,
                {"set_type": "normal"},
                {"exercise": "Curl", "reps": None},
            ],
        },
        "2025-01-02": {},
    }
    daily, sets = readers.read_combined(spark, put("combined", 2, "c.json", document))
    got = daily.orderBy("date").collect()
    assert (got[0].steps, got[0].total_workout_duration, got[0].bodyweight) == (5, "1:05", 0.0)
    assert (got[1].steps, got[1].total_workout_duration, got[1].workout_title) == (0, "0:00", None)
    assert rows(sets.select("pos", "exercise", "muscle_groups", "notes"), "pos") == [
        (0, "Squat", ["Quads"], "n"), (3, "Curl", [], ""),
    ]


CSV = '''title,start_time,end_time,exercise_title,set_type,weight_lbs,reps,distance_miles,duration_seconds,rpe,exercise_notes
Morning,"9 Oct 2025, 7:55","9 Oct 2025, 9:00",Squat (Barbell),normal,50,5,,,,"slow, ""deep""
and steady"
Morning,"9 Oct 2025, 7:55","9 Oct 2025, 9:00",Pull Up,normal,,,,60,8,
Evening,"09 Oct 2025, 17:55","09 Oct 2025, 18:40",Curl,normal,20,12,,,,
Next,"10 Oct 2025, 6:00","10 Oct 2025, 6:45",Curl,warmup,x,12,1.5,,,
Lost,never,"10 Oct 2025, 6:45",Curl,warmup,1,12,,,,
'''


def test_set_log(spark, put):
    raw = readers.read_set_log(spark, put("log", 4, "log.csv", CSV))
    workouts, sets = split_log(parse_set_log(raw))
    assert rows(workouts.select("user_id", F.col("date").cast("string"), "title", "duration"), "date") == [
        (4, "2025-10-09", "Morning", "1:05"), (4, "2025-10-10", "Next", "0:45"),
    ]
    listed = sets.orderBy("date", "pos").collect()
    assert [r.exercise for r in listed] == ["Squat (Barbell)", "Pull Up", "Curl", "Curl"]
    assert listed[0].notes == 'slow, "deep"\nand steady'
    assert (listed[1].weight_lbs, listed[1].reps, listed[1].notes, listed[1].rpe) == (None, None, "", "8")
    assert [r.title for r in unreadable_log_rows(raw).collect()] == ["Lost"]
    assert [r.weight_lbs for r in days.unreadable_sets(sets).collect()] == ["x"]


def test_workout_documents_last_record_of_a_date_wins(spark, put):
    document = [
        {"Date": "2025-01-01", "Workout_Title": "A", "Workout_Duration": "0:30", "exercises": [{"exercise": "Squat"}]},
        {"Date": "2025-01-01", "Workout_Title": "B", "exercises": [{"exercise": "Curl"}, {"exercise": "Row"}]},
    ]
    workouts, sets = readers.read_workout_docs(spark, put("workouts", 1, "w.json", document))
    assert [(r.title, r.duration) for r in workouts.collect()] == [("B", "0:00")]
    assert [r.exercise for r in sets.orderBy("pos").collect()] == ["Curl", "Row"]


def test_legacy_sets(spark, put):
    document = [
        {"date": "2025-01-01", "title": "T", "exercise": "Curl", "weight_lbs": "", "reps": "5", "notes": ""},
        {"date": "2025-01-01", "title": "U", "exercise": "Row", "weight_lbs": "9", "reps": "", "notes": ""},
    ]
    workouts, sets = split_log(legacy_log(readers.read_legacy_sets(spark, put("old", 1, "o.json", document))))
    assert [(r.title, r.duration) for r in workouts.collect()] == [("T", "0:00")]
    assert [(r.weight_lbs, r.reps) for r in sets.orderBy("pos").collect()] == [(None, "5"), ("9", None)]


def test_missing_store_is_empty_and_missing_input_fails(spark, tmp_path):
    assert readers.read_or_empty(spark, str(tmp_path / "none"), SERIES).count() == 0
    with pytest.raises(AnalysisException):
        readers.read_required(spark, str(tmp_path / "none"), SERIES)


def test_whole_text_and_plan_documents(spark, put):
    text = readers.read_whole_text(spark, put("profile", 5, "p.md", "line one\nline two"))
    assert rows(text.select("user_id", "text")) == [(5, "line one\nline two")]
    plan = {"day_focus": "Push", "main_lifts": [{"exercise": "Row", "target_weight_lbs": 95}, {"target_weight_lbs": "95-105"}]}
    got = readers.read_json_docs(spark, put("plans", 5, "p.json", plan), PLAN).first()
    assert [lift.target_weight_lbs for lift in got.main_lifts] == ["95", "95-105"]


def day(text):
    return datetime.date.fromisoformat(text)


def series_frame(spark, *values):
    return spark.createDataFrame([(1, day(d), m, v, 0, "f") for d, m, v in values], SERIES)


def test_upsert_replaces_days_whole_and_only_touched_months(spark, tmp_path):
    path = str(tmp_path / "series")
    merge_into(series_frame(spark, ("2025-01-31", "steps", "1"), ("2025-01-31", "distance", "2"), ("2025-02-01", "steps", "3")), path, SERIES, new_wins)
    before = manifest(spark, path)
    batch = series_frame(spark, ("2025-01-31", "steps", "9"), ("2025-01-30", "steps", "4"))
    assert touched(batch) == ["2025-01"]
    for _ in range(2):  # a replay changes nothing
        merge_into(batch, path, SERIES, new_wins)
        stored = read_table(spark, path, SERIES).select(F.col("date").cast("string"), "metric", "value")
        assert rows(stored, "date", "metric") == [
            ("2025-01-30", "steps", "4"), ("2025-01-31", "steps", "9"), ("2025-02-01", "steps", "3"),
        ]
    after = manifest(spark, path)
    assert after["2025-02"] == before["2025-02"] and after["2025-01"] != before["2025-01"]
    assert drop_old_versions(spark, path, hours=0) == 2 and read_table(spark, path, SERIES).count() == 3


def test_insert_if_absent_keeps_stored_days(spark, tmp_path):
    path = str(tmp_path / "workouts")

    def batch(*values):
        return spark.createDataFrame([(1, day(d), t, "0:30", 0, "f") for d, t in values], WORKOUTS)

    merge_into(batch(("2025-01-01", "A")), path, WORKOUTS, stored_wins)
    for _ in range(2):
        merge_into(batch(("2025-01-01", "X"), ("2025-01-02", "B")), path, WORKOUTS, stored_wins)
        assert [r.title for r in read_table(spark, path, WORKOUTS).orderBy("date").collect()] == ["A", "B"]


def test_json_egress(spark, tmp_path):
    write_json(series_frame(spark, ("2025-01-02", "steps", "2"), ("2025-01-01", "steps", "1")).coalesce(1), str(tmp_path / "j"))
    lines = "".join(f.read_text() for f in Path(current_folder(spark, str(tmp_path / "j"))).glob("*.json")).splitlines()
    assert ['"2025-01-01"' in lines[0], '"2025-01-02"' in lines[1]] == [True, True]


def test_ingest_jobs_end_to_end(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    folder = put("docs", 1, "a.json", DOC)
    ingest_wearable(spark, folder, store, day("2025-01-08"))
    stored = read_table(spark, store.series, SERIES, "day")
    assert {r.date.isoformat() for r in stored.select("date").distinct().collect()} == {"2025-01-02"}
    migrate_legacy(spark, folder, put("stores", 1, "s.json", STORE_DOC), store)
    steps = stored_value(spark, store, "2025-01-01", "steps_activities-steps")
    assert steps == "11"
    log = put("log", 1, "log.csv", CSV)
    ingest_set_log(spark, log, store)
    ingest_set_log(spark, log, store)
    assert read_table(spark, store.sets, SETS).count() == 4 and read_table(spark, store.workouts, WORKOUTS).count() == 2
    assert read_table(spark, store.sets, SETS).filter("exercise = 'Pull Up'").first().duration_seconds == "60"


def stored_value(spark, store, date, metric):
    return read_table(spark, store.series, SERIES, "day").filter((F.col("date") == date) & (F.col("metric") == metric)).first().value


def test_write_table_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(series_frame(spark, ("2025-01-01", "steps", "1")), path)
    write_table(series_frame(spark, ("2025-02-01", "steps", "2")), path)
    assert read_table(spark, path, SERIES).count() == 2


def test_a_write_that_fails_before_the_swap_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_table(series_frame(spark, ("2025-01-01", "steps", "1")), path)

    def broken(*_):
        raise RuntimeError("the driver dies here")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "commit", broken)
        with pytest.raises(RuntimeError):
            merge_into(series_frame(spark, ("2025-01-01", "steps", "2")), path, SERIES, new_wins)
    assert [r.value for r in read_table(spark, path, SERIES).collect()] == ["1"]
    merge_into(series_frame(spark, ("2025-01-01", "steps", "2")), path, SERIES, new_wins)
    assert [r.value for r in read_table(spark, path, SERIES).collect()] == ["2"]


def test_a_refetch_writes_only_its_days(spark, put, tmp_path):
    store = Store(str(tmp_path / "store"))
    folder = put("docs", 1, "a.json", DOC)
    ingest_wearable(spark, folder, store)
    before = manifest(spark, store.series)
    ingest_wearable(spark, folder, store, day("2025-01-08"))
    after = manifest(spark, store.series)
    assert after.keys() == before.keys()
    assert {d for d in after if after[d] != before[d]} == {"2025-01-02"}


HEADER = CSV.split("\n", 1)[0]


def export(*sets):
    """An export whose rows are (day of October, title, exercise, reps)."""
    return HEADER + "\n" + "\n".join(f'"{t}","{d} Oct 2025, 18:00","{d} Oct 2025, 18:30","{e}","normal","10","{r}","","","",""' for d, t, e, r in sets) + "\n"


OLD = export((9, "A", "Squat", 5))
NEW = export(*((d, "B", f"Exercise {i}", 5) for d in (9, 10) for i in range(200)))


@pytest.mark.parametrize("first, second", [("a.csv", "b.csv"), ("b.csv", "a.csv")])
def test_overlapping_exports_count_once(spark, put, tmp_path, first, second):
    import os

    folder = put("log", 1, first, OLD)
    put("log", 1, second, NEW)
    for name, landed in ((first, 1_700_000_000), (second, 1_700_000_100)):
        os.utime(tmp_path / "log" / "user_id=1" / name, (landed, landed))
    store = Store(str(tmp_path / "store"))
    for _ in range(2):
        ingest_set_log(spark, folder, store)
        days_ = read_table(spark, store.sets, SETS).groupBy("date").count()
        assert rows(days_.select(F.dayofmonth("date"), "count"), "dayofmonth(date)") == [(9, 1), (10, 200)]
        assert rows(read_table(spark, store.workouts, WORKOUTS).select("title"), "title") == [("A",), ("B",)]


@pytest.mark.parametrize("large", ["a.json", "b.json"])
def test_the_name_of_a_file_decides_which_record_is_last(spark, put, large):
    def workout(title, n):
        return [{"Date": "2025-01-01", "Workout_Title": title, "Workout_Duration": "0:10", "exercises": [{"exercise": f"E{i}", "notes": "x" * 50} for i in range(n)]}]

    for name in ("a.json", "b.json"):
        folder = put("w", 1, name, workout(f"from {name}", 400 if name == large else 1))
    kept, sets = readers.read_workout_docs(spark, folder)
    assert [r.title for r in kept.collect()] == ["from b.json"] and sets.count() == (400 if large == "b.json" else 1)


def test_a_document_of_many_days_is_reduced_inside_the_document(spark, put):
    from daylog.sources.wearable import document_days, document_points

    days_of = [f"2025-01-{d:02d}" for d in range(1, 29)]
    both = {m: series_of(m, *((d, f"{m}{d}{turn}") for turn in "ab" for d in days_of)) for m in ("steps", "distance", "floors")}
    odd = {"weight": [{"dateTime": "soon", "value": "1"}, {"value": "2"}, {"dateTime": "2025-01-05", "value": None}]}
    docs = readers.read_wearable_docs(spark, put("docs", 1, "a.json", {"date_fetched": "x", "time_series": both | odd, "sleep": None}))
    nested = document_days(docs, ["source_file"])
    assert document_points(docs, ["source_file"]).count() == 3 * 2 * 28 + 1 and nested.count() == 28
    found = as_map(flatten_documents(docs))
    assert found == as_map(flatten_documents(docs, whole_days=False))
    assert found[1, "2025-01-05", "weight"] is None and found[1, "2025-01-05", "steps"] == "steps2025-01-05b"
    assert len(found) == 3 * 28 + 1


def test_whole_days_are_exchanged_once(spark, put):
    docs = readers.read_wearable_docs(spark, put("docs", 1, "a.json", DOC))
    plan = flatten_documents(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_a_session_is_chosen_in_one_scan(spark, put):
    from daylog.sources.setlog import first_sessions

    log = parse_set_log(readers.read_set_log(spark, put("log", 1, "a.csv", CSV)))
    plan = first_sessions(log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_an_export_is_read_once_and_its_unreadable_rows_are_kept(spark, put, tmp_path):
    from daylog.schemas import LOG_ROW

    store = Store(str(tmp_path / "store"))
    text = export((9, "A", "Squat", 5), (10, "B", "Curl", 5)).replace("10 Oct 2025, 18:00", "some day")
    folder = put("log", 1, "a.csv", text)
    for _ in range(2):
        ingest_set_log(spark, folder, store)
    bad = read_table(spark, f"{store.bad_rows}/log", LOG_ROW, "whole").collect()
    assert [(r.user_id, r.start_time, r.exercise_title) for r in bad] == [(1, "some day", "Curl")]
    assert read_table(spark, store.sets, SETS).count() == 1 and read_table(spark, store.workouts, WORKOUTS).count() == 1
