import datetime
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from daylog.operators import coach, days, dims, feed, ranking, trends, weeks, workouts
from daylog.plans.daily import build_payload, Combined, combine, dashboard, feed_of_all

from .conftest import rows

SET = (
    "user_id bigint, date date, pos bigint, exercise string, set_type string, weight_lbs double, reps int, "
    "distance double, notes string, muscle_groups array<string>"
)


def day(text):
    return datetime.date.fromisoformat(text)


def training(spark, *entries):
    """Sets from (user, date, exercise, weight, reps, notes) with muscles of the second table version."""
    counter = Counter()
    records = []
    for user, date, exercise, weight, reps, notes in entries:
        records.append((user, day(date), counter[user, date], exercise, "normal", weight, reps, None, notes, None))
        counter[user, date] += 1
    return dims.attach_dim(spark.createDataFrame(records, SET), dims.exercise_dim(spark, 2)).drop("met")


def test_dimension_versions(spark):
    three, two = dims.exercise_dim(spark, 3), dims.exercise_dim(spark, 2)
    counts = [(d.filter("muscle_groups is not null").count(), d.filter("met is not null").count()) for d in (three, two)]
    assert counts == [(49, 46), (47, 46)]
    assert two.filter("exercise = 'Lat Pulldown Burn Outs'").first().met == 5.5
    assert two.filter("exercise = 'Overhead Press'").first().muscle_groups == ["Shoulders", "Triceps"]


def test_unmapped_and_default_intensity(spark):
    sets = training(spark, (1, "2025-01-01", "Juggling", 0.0, 5, ""), (1, "2025-01-01", "Squat", 1.0, 5, ""), (2, "2025-01-01", "Juggling", 0.0, 5, ""))
    dim = dims.exercise_dim(spark)
    assert rows(dims.unmapped_exercises(sets, dim)) == [("Juggling", 2)]
    found = dims.attach_dim(sets, dims.checked_broadcast(dim)).filter("exercise = 'Juggling'").first()
    assert (found.met, found.muscle_groups) == (5.0, [])


def test_a_large_lookup_is_not_broadcast(spark):
    dim = dims.exercise_dim(spark)
    small = dims.checked_broadcast(dim)._jdf.queryExecution().analyzed().toString()
    large = dims.checked_broadcast(dim, max_rows=10)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in small and "broadcast" not in large


def test_combine_meets_all_three_sides(spark):
    series = spark.createDataFrame(
        [
            (1, day("2025-01-01"), "steps", 100.0, 1),
            (1, day("2025-01-01"), "calories_out", 2000.0, 1),
            (1, day("2025-01-02"), "weight", 161.5, 1),
        ],
        "user_id bigint, date date, metric string, value double, seq bigint",
    )
    workouts_ = spark.createDataFrame(
        [(1, day("2025-01-02"), "Push", "1:05", 0), (1, day("2025-01-03"), "Pull", "0:45", 0)],
        "user_id bigint, date date, title string, duration string, seq bigint",
    )
    log = spark.createDataFrame(
        [
            (1, day("2025-01-02"), 0, "Bench Press", "normal", "100", "10", None, None, None, ""),
            (1, day("2025-01-02"), 1, "Bench Press", "normal", None, "", "1.5", "60", None, ""),
        ],
        "user_id bigint, date date, pos bigint, exercise string, set_type string, weight_lbs string, reps string, "
        "distance_miles string, duration_seconds string, rpe string, notes string",
    )
    combined = combine(series, workouts_, days.typed_sets(log), dims.exercise_dim(spark))
    one, two, three = combined.daily.orderBy("date").collect()
    assert (one.steps, one.total_calories_burned, one.workout_title, one.total_workout_duration) == (100, 2000, None, "0:00")
    calories = int(6 * 3.5 * (160 * 0.453592) / 200 * 0.5 + 6 * 3.5 * (160 * 0.453592) / 200 * 1.0)
    assert (two.bodyweight, two.workout_title, two.calories_burned_from_workout) == (161.5, "Push", calories)
    assert (three.steps, three.workout_title, three.calories_burned_from_workout) == (0, "Pull", 0)
    sets = combined.sets.orderBy("pos").collect()
    assert (sets[0].weight_lbs, sets[0].reps, sets[0].muscle_groups) == (100.0, 10, ["Chest", "Triceps", "Shoulders"])
    assert (sets[1].weight_lbs, sets[1].reps, sets[1].distance) == (0.0, None, 1.5)


def golden_day(spark):
    """Two muscles share the top count; the one met first decides the focus."""
    listed = (
        [("Chin Up", 0.0, 6)] * 4 + [("Seated Row (Machine)", 70.0, 8)] * 3 + [("Bench Press", 120.0, 5)] * 4
        + [("Lateral Raise (Dumbbell)", 15.0, 12)] * 3 + [("Squat (Barbell)", 145.0, 5)] * 3
    )
    return training(spark, *((1, "2025-11-06", e, w, r, "") for e, w, r in listed))


def test_focus_tie_goes_to_the_muscle_met_first(spark):
    sets = golden_day(spark)
    groups = workouts.exercise_groups(sets)
    counts = {r.muscle: r.sets for r in workouts.muscle_sets(groups).collect()}
    assert counts["back"] == counts["shoulders"] == 7 and len(counts) == 9
    assert rows(workouts.workout_focus(groups).select("focus")) == [("pull",)]


def test_focus_without_muscles_is_other(spark):
    groups = workouts.exercise_groups(training(spark, (1, "2025-01-01", "Juggling", 0.0, 5, "")))
    assert rows(workouts.workout_focus(groups).select("focus")) == [("other",)]


def test_key_lifts_round_half_even_and_keep_first_of_equals(spark):
    entries = [("Triceps Rope Pushdown", 32.5, r) for r in (7, 7, 7, 8)]
    entries += [("Curl", 10.0, 6), ("Row", 10.0, 6), ("Fly", 10.0, 6), ("Plank", None, 60)]
    groups = workouts.exercise_groups(training(spark, *((1, "2025-01-01", e, w, r, "") for e, w, r in entries)))
    lifts = workouts.key_lifts(workouts.exercise_stats(groups)).orderBy("rank").collect()
    assert [r.exercise for r in lifts] == ["Triceps Rope Pushdown", "Curl", "Row"]
    assert (lifts[0].avg_reps, lifts[0].avg_weight) == (7.2, 32.5)
    plank = workouts.exercise_stats(groups).filter("exercise = 'Plank'").first()
    assert (plank.avg_weight, plank.score, plank.muscles) == (None, 0.0, [])


def test_names_are_trimmed_but_muscles_stay_with_the_written_name(spark):
    sets = training(spark, (1, "2025-01-01", "Squat", 10.0, 5, ""), (1, "2025-01-01", " Squat ", 20.0, 5, ""), (1, "2025-01-01", "", 5.0, 1, ""))
    stats = {r.exercise: r for r in workouts.exercise_stats(workouts.exercise_groups(sets)).collect()}
    assert set(stats) == {"Squat", "unknown"}
    assert (stats["Squat"].sets, stats["Squat"].avg_weight, stats["Squat"].muscles) == (2, 15.0, ["glutes", "hamstrings", "quads"])


def test_notes_follow_exercise_then_set(spark):
    sets = training(
        spark,
        (1, "2025-01-01", "A", 1.0, 1, ""), (1, "2025-01-01", "B", 1.0, 1, " b1 "), (1, "2025-01-01", "A", 1.0, 1, "a2"),
        (1, "2025-01-01", "B", 1.0, 1, "b2"), (1, "2025-01-01", "A", 1.0, 1, "a3"), (1, "2025-01-01", "C", 1.0, 1, "c1"),
        (1, "2025-01-01", "C", 1.0, 1, "c2"),
    )
    notes = workouts.workout_notes(sets, workouts.exercise_groups(sets)).first().notes
    assert notes == "a2 | a3 | b1 | b2 | c1"


def reference_text(entries):
    """Brute force of the workout text from a list of (exercise, weight, reps, notes)."""
    grouped, notes = defaultdict(list), {}
    for exercise, weight, reps, note in entries:
        grouped[exercise].append((weight, reps))
        if note:
            notes[exercise] = note
    lines = []
    for exercise, listed in grouped.items():
        lines.append(exercise)
        if exercise in notes:
            lines.append(f'"{notes[exercise]}"')
        for i, (weight, reps) in enumerate(listed, 1):
            lines.append(f"Set {i}: {int(weight)} lbs x {reps}" if weight else f"Set {i}: {reps} reps")
        lines.append("")
    return "\n".join(lines).strip()


def test_workout_text_equals_brute_force_over_blocks(spark, monkeypatch):
    random.seed(11)
    entries = [
        (random.choice(["Squat", " Curl", "Row"]), random.choice([0.0, None, 20.5, -3.7]), random.choice([None, 5, 12]), random.choice(["", "", "n1", "n2"]))
        for _ in range(300)
    ]
    sets = training(spark, *((1, "2025-01-01", *e) for e in entries))
    whole = reference_text(entries)
    assert [r.text for r in workouts.workout_text(sets).collect()] == [whole]
    monkeypatch.setattr(ranking, "BLOCK_BITS", 4)
    assert [r.text for r in workouts.workout_text(sets).collect()] == [whole]


def test_sets_are_shuffled_once_for_their_texts(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_BITS", 2)
    days = ["2025-01-01", "2025-01-02", "2025-01-03"]
    entries = [(user, day, name, float(i), i, note) for user in (1, 2) for day in days for i, (name, note) in enumerate([("B", ""), ("A", "first"), ("B", "x"), ("A", "")] * 5)]
    sets = training(spark, *entries)
    texts = workouts.workout_text(sets)
    got = {(r.user_id, str(r.date)): r.text for r in texts.collect()}
    assert got == {(u, d): reference_text([e[2:] for e in entries if e[:2] == (u, d)]) for u in (1, 2) for d in days}
    before, after = (f._jdf.queryExecution().sparkPlan().toString().count("Exchange") + f._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange") for f in (sets, texts))
    assert after - before == 2  # the plan as it was chosen and as it was run hold the one exchange each


def test_position_comes_before_ties_of_any_size(spark):
    entries = [(1, "2025-01-01", "Squat", w, 5, n) for w, n in ((1.0, "first"), (2.0, ""), (3.0, "second"))]
    weight = F.col("weight_lbs")
    tie = F.when(weight == 1.0, 9_000).when(weight == 2.0, 10).otherwise(20_000_000)
    sets = training(spark, *entries).withColumns({"pos": weight.cast("bigint"), "tie": tie.cast("bigint")})
    numbers = {r.weight_lbs: r.set_number for r in workouts.numbered_sets(sets).collect()}
    assert numbers == {1.0: 1, 2.0: 2, 3.0: 3}
    assert workouts.exercise_last_note(sets).first().note == "second"
    assert workouts.workout_text(sets).first().text == 'Squat\n"second"\nSet 1: 1 lbs x 5\nSet 2: 2 lbs x 5\nSet 3: 3 lbs x 5'


def test_row_numbers_equal_a_plain_window_in_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_BITS", 5)
    entries = [(1 if i % 3 else i, "2025-01-01", "Squat" if i % 2 else "Row", 1.0 * i, 5, "") for i in range(600)]
    numbered = workouts.numbered_sets(training(spark, *entries))
    seen = Counter()
    for user, exercise, _, number in sorted(rows(numbered.select("user_id", "exercise", "pos", "set_number"))):
        seen[user, exercise] += 1
        assert number == seen[user, exercise]


def many_days(spark, user=1):
    return training(
        spark,
        *((user, f"2025-01-{d:02d}", "Squat" if d % 2 else "Bench Press", 100.0 + d, 5, f"note {d}") for d in (1, 3, 4, 9, 20)),
    )


def test_recent_and_oldest_workouts(spark):
    sets = many_days(spark)
    newest = coach.recent_summaries(sets, 3).orderBy("recency").select("summary.*").collect()
    assert [s.date for s in newest] == ["2025-01-20", "2025-01-09", "2025-01-04"]
    assert (newest[1].focus, newest[1].volume_sets, newest[1].notes) == ("legs", {"quads": 1, "glutes": 1, "hamstrings": 1}, "note 9")
    oldest = coach.recent_summaries(sets, 2, newest=False).orderBy("recency").collect()
    assert [r.date.day for r in oldest] == [1, 3]
    until = coach.recent_summaries(sets, 2, until=day("2025-01-05")).orderBy("recency").collect()
    assert [r.date.day for r in until] == [4, 3]


def test_recent_workouts_make_only_the_sets_of_chosen_days(spark):
    sets, asked = many_days(spark).unionByName(many_days(spark, 2)), []

    def sets_of(chosen):
        asked.append(sorted(rows(chosen)))
        return sets.join(chosen, ["user_id", "date"], "left_semi")

    for newest, last in ((True, [9, 20]), (False, [1, 3])):
        plain = coach.recent_summaries(sets, 2, newest=newest)
        given = coach.recent_summaries(sets, 2, newest=newest, sets_of=sets_of)
        assert rows(given, "user_id", "date") == rows(plain, "user_id", "date")
        assert asked.pop() == [(user, datetime.date(2025, 1, d)) for user in (1, 2) for d in last]


DAILY = (
    "user_id bigint, date date, steps bigint, distance double, total_calories_burned bigint, sleep_hours double, "
    "sleep_score int, workout_title string, total_workout_duration string, calories_burned_from_workout bigint, "
    "calories_burned_from_steps bigint, resting_heart_rate int, bodyweight double"
)


def daily_frame(spark, *entries):
    blank = dict(steps=0, distance=0.0, total=0, sleep=0.0, score=None, title=None, duration="0:00", cw=0, cs=0, hr=0, bw=0.0)
    records = []
    for user, date, values in entries:
        v = {**blank, **values}
        records.append((user, day(date), v["steps"], v["distance"], v["total"], v["sleep"], v["score"], v["title"], v["duration"], v["cw"], v["cs"], v["hr"], v["bw"]))
    return spark.createDataFrame(records, DAILY)


def test_payload(spark):
    daily = daily_frame(
        spark,
        (1, "2025-01-09", dict(sleep=5.5, score=80, hr=55, bw=0.0)), (1, "2025-01-10", dict(bw=161.5)),
        (2, "2025-01-01", dict(steps=1)), (3, "2025-01-09", dict(sleep=6.0, bw=150.0)), (3, "2025-01-10", dict(bw=1.0)),
    )
    payload = build_payload(Combined(daily, many_days(spark)), day("2025-01-10"))
    one, two, three = payload.orderBy("user_id").collect()
    assert one.sleep_last_night.asDict() == {"hours": 5.5, "score": 80, "resting_hr": 55}
    assert (one.bodyweight, one.low_sleep_flag, one.week_volume) == (161.5, True, {"quads": 1, "glutes": 1, "hamstrings": 1})
    assert [w.date for w in one.recent_workouts] == ["2025-01-20", "2025-01-09", "2025-01-04"]
    assert one.last_workout_summary == one.recent_workouts[0]
    assert (two.bodyweight, two.low_sleep_flag, two.week_volume, two.recent_workouts) == (None, False, {}, [])
    assert (two.last_workout_summary.had_workout, two.sleep_last_night.hours) == (False, None)
    assert (three.bodyweight, three.low_sleep_flag) == (150.0, False)
    texts = {r.user_id: r.payload for r in coach.payload_json(payload).collect()}
    assert '"last_workout_summary":{"had_workout":false}' in texts[2] and '"hours":null' in texts[2]
    assert '"date_for_plan":"2025-01-10"' in texts[1] and '"focus":"push"' in texts[1]


def test_week_volume_bounds(spark):
    sets = training(spark, *((1, d, "Squat", 1.0, 1, "") for d in ("2024-12-29", "2024-12-30", "2025-01-05", "2025-01-06")))
    assert {r.sets for r in weeks.week_volume(sets, day("2025-01-01")).collect()} == {2}


def test_trailing_bounds_are_inclusive_and_anchor_on_mapped_sets(spark):
    dates = ("2025-01-01", "2025-01-02", "2025-02-01")
    sets = training(spark, *((1, d, "Face Pull", 1.0, 1, "") for d in dates), (1, "2025-03-30", "Juggling", 1.0, 1, ""))
    per_week = weeks.weekly_sets_trailing(sets).groupBy("muscle").agg(F.sum("sets").alias("n"))
    assert rows(per_week, "muscle") == [("Rear Delts", 2), ("Traps", 2)]
    weekly = training(spark, *((1, d, "Squat", 10.0, 2, "") for d in ("2025-01-06", "2025-01-13", "2025-02-10")))
    ranked = weeks.weekly_weight_ranked(weekly).orderBy("week", "rank").collect()
    assert [(r.week.isoformat(), r.rank, r.muscle) for r in ranked] == [
        (w, i, m) for w in ("2025-01-13", "2025-02-10") for i, m in enumerate(["Glutes", "Hamstrings", "Quads"], 1)
    ]


def test_weekly_counts_add_up_to_daily_counts(spark):
    sets = golden_day(spark).unionByName(many_days(spark))
    weekly = weeks.weekly_sets(sets).agg(F.sum("sets")).first()[0]
    assert weekly == weeks.muscle_days(sets).agg(F.sum("sets")).first()[0] == sets.agg(F.sum(F.size("muscle_groups"))).first()[0]


def test_progress_counts_training_weeks(spark):
    dates = ("2025-01-06", "2025-01-13", "2025-02-10", "2025-03-10")
    sets = training(spark, *((1, d, "Squat", 10.0, i, "") for i, d in enumerate(dates, 1)))
    trend = weeks.weekly_progress(sets).orderBy("week").collect()
    assert [(r.volume, r.volume_rolling) for r in trend] == [(10.0, 10.0), (20.0, 15.0), (30.0, 20.0), (40.0, 30.0)]


def test_averages_take_valid_days_only(spark):
    daily = daily_frame(
        spark,
        (1, "2025-01-01", dict(steps=100, total=500, cs=0, duration="1:10", sleep=7.5)),
        (1, "2025-01-02", dict(steps=0, total=2000, cs=1900, duration="0:00", sleep=0.0)),
        (1, "2025-01-03", dict(steps=301, total=1000, cs=1000, duration="0:50")),
        (2, "2025-01-01", {}),
    )
    means = trends.averages(daily)
    assert rows(means, "user_id") == [(1, 200.5, 0.0, 7.5, 60.0, 1500.0), (2, 0.0, 0.0, 0.0, 0.0, 0.0)]
    lines = {r.block: r.text for r in trends.averages_lines(means.filter("user_id = 1")).collect()}
    assert lines["steps"] == "Average Daily Steps: 200" and lines["workout_duration"] == "Average Workout Duration: 1 hr 0 min"
    report = {r.block: r.text for r in trends.averages_report(means.filter("user_id = 1")).collect()}
    assert report["sleep"] == "- Sleep Duration: 7.50 hours" and report["workout_duration"] == "- Workout Duration: 1 hr 0 min"


def test_rolling_means_count_rows_and_ranges_use_their_own_rule(spark):
    days_ = spark.createDataFrame(
        [(1, day(f"2025-01-{d:02d}"), d, float(d), 90 * d) for d in (1, 2, 3, 10, 11, 12, 13, 31)] + [(2, day("2025-01-01"), 0, 0.0, 0)],
        "user_id bigint, date date, steps int, sleep_hours double, total_calories int",
    )
    rolled = trends.rolling_means(days_).filter("user_id = 1").orderBy("date").collect()
    assert rolled[0].steps_rolling == 1.0 and rolled[-1].steps_rolling == (2 + 3 + 10 + 11 + 12 + 13 + 31) / 7
    ranges = {r.user_id: r for r in trends.valid_ranges(days_).collect()}
    assert (ranges[1].steps_from.day, ranges[1].total_calories_from.day, ranges[2].steps_from) == (1, 2, None)
    old = {r.user_id: r for r in trends.valid_ranges(days_, zero_is_valid=True).collect()}
    assert old[2].steps_from.day == 1
    lines = trends.reference_lines(days_)
    assert {r.user_id: r.avg_steps for r in lines.collect()}[2] is None
    means = {r.user_id: r.steps_total_average for r in trends.with_user_means(days_).collect()}
    assert means == {1: 83 / 8, 2: 0.0}


def test_dashboard_falls_back_on_the_estimate(spark):
    sets = training(spark, (1, "2025-01-01", "Squat", 100.0, 10, ""), (1, "2025-01-02", "Squat", 100.0, 2, ""))
    daily = daily_frame(spark, (1, "2025-01-01", dict(cw=77)), (1, "2025-01-02", {}), (1, "2025-01-03", {}))
    table = dashboard(Combined(daily, sets), dims.exercise_dim(spark, 2)).orderBy("date").collect()
    assert [r.workout_calories for r in table] == [77.0, round(7 * 3.5 * 72 / 200 * 0.3, 1), 0.0]
    assert [(r.total_sets, r.total_reps, r.total_weight_lifted) for r in table] == [(1, 10, 1000.0), (1, 2, 200.0), (0, 0, 0.0)]


def test_feed(spark):
    daily = daily_frame(
        spark,
        (1, "2025-01-01", dict(steps=12345, sleep=7.25, total=2950, hr=55, bw=161.2, duration="1:05")),
        (1, "2025-01-02", {}), (1, "2025-01-03", dict(duration="0:30")),
    )
    sets = training(spark, (1, "2025-01-01", "Squat", 95.5, None, "deep"))
    got = {(r.date.day, r.metric_type): (r.label[r.label.index(" ") + 1 :], r.value) for r in feed_of_all(Combined(daily, sets)).collect()}
    assert got == {
        (1, "Steps"): ("12,345", "12345"), (1, "Sleep"): ("7 hr 15 min", "7.25"), (1, "Calories"): (f"{round(2950 / 1000, 1)}k cal", "2950"),
        (1, "Heart Rate"): ("55 BPM", "55"), (1, "Weight"): ("161.2 lbs", "161.2"),
        (1, "Workout"): ("1:05", 'Squat\n"deep"\nSet 1: 95 lbs x None'), (3, "Workout"): ("0:30", ""),
    }


def test_missing_days(spark):
    daily = daily_frame(spark, (1, "2025-01-01", {}), (1, "2025-01-03", {}), (2, "2025-02-01", {}))
    gaps = feed.missing_days(daily, day("2025-01-01"), day("2025-01-03"))
    assert [(u, d.day) for u, d in rows(gaps, "user_id", "date")] == [(1, 2), (2, 1), (2, 2), (2, 3)]
    assert feed.missing_days(daily, day("2025-01-03"), day("2025-01-01")).count() == 0
