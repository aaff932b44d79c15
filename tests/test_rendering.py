import datetime
import json

from pyspark.sql import functions as F

from daylog.functions.text import fill_template
from daylog.plans import rendering
from daylog.schemas import PAYLOAD


PLAN = {
    "day_focus": "Push",
    "warmup": ["walk", "row"],
    "main_lifts": [
        {"exercise": "Press", "sets": 4, "reps_range": "5-8", "target_weight_lbs": 95, "rpe_range": "7", "notes": "slow"},
        {"exercise": "Pull Up (Assisted)", "sets": 3, "reps_range": "5", "assistance_lbs": 40},
    ],
    "accessories": [{"exercise": "Raise", "sets": 3, "target_weight_lbs": "15-20"}],
    "conditioning": "bike",
    "macros": {"protein_target_g": 150},
    "notes": "rest well",
}


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id int, text string")


def test_plans_are_read_from_bare_fenced_and_prefixed_text(spark):
    body = json.dumps(PLAN, indent=2)
    frame = texts(spark, body, f"```json\n{body}\n```", f"json\n{body} \n", "no plan", '{"day_focus": ', "[1]", "{}", None)
    plans = rendering.plan_rows(frame)
    assert [r.id for r in plans.orderBy("id").collect()] == [0, 1, 2, 6]
    first = plans.filter("id = 1").first().plan
    assert (first.day_focus, first.warmup, first.macros.protein_target_g) == ("Push", ["walk", "row"], 150)
    assert [lift.target_weight_lbs for lift in first.main_lifts] == ["95", None]
    assert sorted(r.id for r in rendering.unreadable_plans(frame.filter("text is not null")).collect()) == [3, 4, 5]


def test_workout_html(spark):
    frame = rendering.plan_rows(texts(spark, json.dumps(PLAN), "{}"))
    full, empty = (r[0] for r in frame.orderBy("id").select(rendering.workout_html()).collect())
    assert "<h3>Focus</h3><p>Push</p>" in full and "<ul><li>walk</li><li>row</li></ul>" in full
    assert "Sets × Reps: 4×5-8<br>\n        Weight / Assistance: 95<br>" in full
    assert "Weight / Assistance: 40<br>\n        RPE: <br>" in full
    assert "Weight: 15-20<br>" in full and "<p>rest well</p>" in full
    assert "<p>Full Body</p>" in empty and "<ul></ul>" in empty and "<strong>" not in empty


def test_card_html(spark):
    frame = rendering.plan_rows(texts(spark, json.dumps(PLAN), "{}"))
    full, empty = (r[0] for r in frame.orderBy("id").select(rendering.card_html()).collect())
    assert "Focus: Push" in full and "<ul>bike</ul>" in full and '<li>{"exercise":"Raise"' in full
    assert empty.count("<li>None</li>") == 3 and "Focus: N/A" in empty


def test_template_slots(spark):
    frame = rendering.plan_rows(texts(spark, json.dumps(PLAN)))
    page = "{{date}}|{{day_focus}}|{{main_lifts}}|{{accessories}}|{{conditioning}}|{{warmup}}|{{notes}}"
    shown = frame.select(fill_template(page, rendering.template_slots(F.lit("2025-01-01")))).first()[0]
    assert shown == (
        "2025-01-01|Push|<li>Press</li><li>Pull Up (Assisted)</li>|<li>Raise</li>|bike|walk, row|rest well"
    )


def test_prompt(spark):
    payload = spark.createDataFrame([("{}",)], "t string").select(
        F.lit(1).cast("bigint").alias("user_id"), F.from_json(F.lit('{"sleep_last_night": {"hours": 7.5}}'), PAYLOAD).alias("p")
    ).select("user_id", "p.*")
    profiles = spark.createDataFrame([(1, "likes {{today}}")], "user_id bigint, text string")
    prompt = rendering.prompt_text(payload, profiles, datetime.date(2025, 1, 2)).first().prompt
    assert "Stable Profile:\nlikes {{today}}\n" in prompt and "- Sleep: 7.5 hours, None" in prompt
    assert prompt.rstrip().endswith("macros.") and "Today's date:\n2025-01-02" in prompt
