import random

from pyspark.sql import functions as F

from daylog.functions import classify, dates, effort, numbers, text

from .conftest import rows


def one(spark, column, **values):
    frame = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return frame.select(column).first()[0]


def test_round_exact_is_half_even_on_the_binary_value(spark):
    random.seed(3)
    values = [7.25, 148.75, 0.35, 2.25, 128.75, 0.15, -7.25, 1e9 + 0.25] + [random.uniform(-1e6, 1e6) for _ in range(300)]
    values += [random.randrange(10**6) / 8 for _ in range(200)]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", numbers.round_exact(F.col("v"), 1), numbers.round_exact(F.col("v"), 2), numbers.fixed(F.col("v"), 1)
    )
    for v, tenth, hundredth, shown in rows(got):
        assert (tenth, hundredth, shown) == (round(v, 1), round(v, 2), f"{v:.1f}")


def test_float_text_has_no_exponent(spark):
    for value in (161.2, 70.0, 0.0, 12345678.5, 0.0005, 98.05):
        assert one(spark, numbers.float_text(F.col("v")), v=value) == repr(value)


def test_cast_or_covers_absent_empty_and_unreadable(spark):
    frame = spark.createDataFrame([("12",), ("",), (None,), ("12.7",), ("x",)], "v string")
    assert [r[0] for r in frame.select(numbers.cast_or(F.col("v"), "int", 0)).collect()] == [12, 0, 0, 0, 0]


def test_exact_sum_equals_decimal_sum_in_any_order(spark):
    random.seed(5)
    values = [round(random.uniform(-1000, 100000), 2) for _ in range(4000)]
    cents = sum(round(v * 100) for v in values)
    for parts in (1, 7, 40):
        frame = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        assert float(frame.agg(numbers.exact_sum(F.col("v"))).first()[0]) == cents / 100


def test_durations(spark):
    frame = spark.createDataFrame([(0,), (45,), (65,), (150,), (600,)], "m int")
    shown = frame.select(dates.duration_text(F.col("m")), dates.duration_minutes(dates.duration_text(F.col("m"))))
    assert rows(shown) == [("0:00", 0), ("0:45", 45), ("1:05", 65), ("2:30", 150), ("10:00", 600)]
    assert one(spark, dates.hours_minutes_text(F.col("m")), m=80.7) == "1 hr 21 min"
    assert one(spark, dates.hours_minutes_text(F.col("m")), m=45.2) == "45 min"
    assert one(spark, dates.hours_minutes_text(F.col("m")), m=119.8) == "1 hr 60 min"
    assert one(spark, dates.sleep_text(F.col("h")), h=7.9166666) == "7 hr 55 min"
    assert one(spark, dates.sleep_text(F.col("h")), h=0.5) == "0 hr 30 min"


def test_log_time_takes_one_digit_hours(spark):
    frame = spark.createDataFrame([("9 Oct 2025, 7:55",), ("09 Oct 2025, 17:55",), ("soon",)], "t string")
    got = [r[0] for r in frame.select(dates.log_timestamp(F.col("t")).cast("string")).collect()]
    assert got == ["2025-10-09 07:55:00", "2025-10-09 17:55:00", None]


def test_iso_date_takes_only_the_full_form(spark):
    frame = spark.createDataFrame([("2025-11-16",), ("2025-1-5",), ("20251116",), ("2025-02-30",), ("x",)], "t string")
    got = [r[0] for r in frame.select(dates.iso_date(F.col("t")).cast("string")).collect()]
    assert got == ["2025-11-16", None, None, None, None]


def test_iso_week_across_the_year_end(spark):
    day = F.to_date(F.lit("2024-12-30"))
    found = spark.range(1).select(dates.iso_year(day), dates.iso_week(day), dates.week_start(day).cast("string"))
    assert tuple(found.first()) == (2025, 1, "2024-12-30")
    monday, sunday = dates.week_bounds(dates.as_date("2025-01-05"))
    assert (monday.isoformat(), sunday.isoformat()) == ("2024-12-30", "2025-01-05")


def test_short_numbers(spark):
    frame = spark.createDataFrame([(512,), (1000,), (9250,), (999999,), (1250000,)], "n bigint")
    assert [r[0] for r in frame.select(dates.short_number(F.col("n"))).collect()] == [
        "512", "1.0k", "9.2k", "1000.0k", "1.2M",
    ]
    assert one(spark, numbers.thousands(F.col("n")), n=1234567) == "1,234,567"


def test_effective_weight_rules_in_order(spark):
    frame = spark.createDataFrame(
        [
            ("Squat (Barbell)", "", 50.0, 145.0),
            ("Squat (Barbell)", "", 0.0, 45.0),
            ("Barbell Pull Up (Assisted)", "", 10.0, 65.0),
            ("Pull Up (Assisted)", "", 40.0, 120.0),
            ("Chin Up (Assisted)", "", 0.0, 160.0),
            ("Press (Smith Machine)", "", 30.0, 60.0),
            ("Row", "on the Smith", 30.0, 60.0),
            ("Pull Up", "", 5.0, 160.0),
            ("Press", "chest dip form", 5.0, 160.0),
            ("Chest Dip", "", 5.0, 5.0),
            ("Curl", None, 20.0, 20.0),
        ],
        "exercise string, notes string, w double, expected double",
    )
    weight = effort.effective_weight(F.col("w"), F.col("exercise"), F.col("notes"), F.lit(160.0))
    for exercise, got, expected in rows(frame.select("exercise", weight, "expected")):
        assert got == expected, exercise


def test_set_calories(spark):
    def calories(seconds):
        return one(spark, effort.set_calories(F.col("met"), F.col("reps"), F.col("s").cast("int"), F.lit(160.0)), met=6.0, reps=10, s=seconds)

    base = 6.0 * 3.5 * (160 * 0.453592) / 200
    assert calories("0") == base * (10 * 3 / 60)
    assert calories("60") == base * 1.0
    assert one(spark, effort.fallback_set_calories(F.col("met"), F.col("r")), met=5.0, r=2) == 5 * 3.5 * 72 / 200 * 0.3


def test_muscles_focus_and_flags(spark):
    frame = spark.createDataFrame([(" Back ",), ("",), (None,)], "m string")
    assert [r[0] for r in frame.select(classify.muscle_key(F.col("m"))).collect()] == ["back", "other", "other"]
    focus = spark.createDataFrame([("back",), ("chest",), ("glutes",), ("abs",), (None,)], "m string")
    assert [r[0] for r in focus.select(classify.focus_of(F.col("m"))).collect()] == ["pull", "push", "legs", "abs", "other"]
    sleep = spark.createDataFrame([(5.9,), (6.0,), (None,)], "h double")
    assert [r[0] for r in sleep.select(classify.low_sleep(F.col("h"))).collect()] == [True, False, False]
    steps = spark.createDataFrame([(10000.0,), (9999.0,), (4999.0,)], "s double")
    assert [r[0] for r in steps.select(classify.steps_colour(F.col("s"))).collect()] == ["green", "orange", "red"]


def test_strip_takes_every_blank(spark):
    assert one(spark, text.strip(F.col("t")), t="\n\t a b 　\r\n") == "a b"


def test_code_fences(spark):
    for raw in ('{"a": 1}', '```json\n{"a": 1}\n```', 'json\n{"a": 1}  ', ' \n{"a": 1}\n\n'):
        assert one(spark, text.strip_code_fences(F.col("t")), t=raw) == '{"a": 1}'


def test_template_values_are_not_filled_again(spark):
    page = text.fill_template("{{a}}-{{b}}-{{c}}", {"a": F.lit("{{b}}"), "b": F.lit("x")})
    assert one(spark, page) == "{{b}}-x-{{c}}"
    column = text.fill_template_column(F.lit("{{a}}-{{b}}"), {"a": F.lit("1"), "b": F.lit(None)})
    assert one(spark, column) == "1-"
