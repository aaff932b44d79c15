"""Declared schemas of the tables and landed documents. No reader infers a schema."""

from __future__ import annotations

# --- landed documents -------------------------------------------------------------------

SLEEP_ENTRY = "struct<dateOfSleep:string,duration:string,efficiency:string,startTime:string,endTime:string>"
# Ragged objects are kept as JSON text and opened by the flattening operator.
WEARABLE_DOC = f"date_fetched string, time_series map<string,string>, sleep array<{SLEEP_ENTRY}>"
SERIES_POINTS = "array<struct<dateTime:string,value:string>>"

# Header of the exported set log, in file order.
SET_LOG_COLUMNS = (
    "title start_time end_time exercise_title set_type weight_lbs reps "
    "distance_miles duration_seconds rpe exercise_notes"
).split()
SET_LOG = ", ".join(f"{name} string" for name in SET_LOG_COLUMNS)
# A row of an export as it was read, with its place and its export.
LOG_ROW = f"user_id bigint, {SET_LOG}, pos bigint, source string"

WORKOUT_DOC = (
    "Date string, Workout_Title string, Workout_Duration string, "
    "exercises array<struct<exercise:string,set_type:string,weight_lbs:string,reps:string,"
    "distance_miles:string,duration_seconds:string,rpe:string,notes:string>>"
)
LEGACY_SET_DOC = (
    "date string, title string, exercise string, set_type string, weight_lbs string, reps string, "
    "distance_miles string, duration_seconds string, rpe string, notes string"
)

COMBINED_SET = (
    "struct<exercise:string,set_type:string,weight_lbs:double,reps:bigint,distance:double,"
    "notes:string,muscle_groups:array<string>>"
)
COMBINED_DAY = (
    "struct<steps:bigint,distance:double,total_calories_burned:bigint,sleep_hours:double,sleep_score:int,"
    "workout_title:string,total_workout_duration:string,calories_burned_from_workout:bigint,"
    "calories_burned_from_steps:bigint,resting_heart_rate:int,bodyweight:double,"
    f"exercises:array<{COMBINED_SET}>>"
)

LIFT = (
    "struct<exercise:string,sets:string,reps_range:string,target_weight_lbs:string,"
    "assistance_lbs:string,rpe_range:string,notes:string>"
)
PLAN = (
    f"day_focus string, warmup array<string>, main_lifts array<{LIFT}>, accessories array<{LIFT}>, "
    "conditioning string, step_goal string, macros struct<protein_target_g:int,notes:string>, notes string"
)

PLAN_STRUCT = "struct<" + ",".join(field.replace(" ", ":", 1) for field in PLAN.split(", ")) + ">"
# ``landed`` orders the answers for one plan date; the last one counts.
STORED_PLAN = f"user_id bigint, date date, landed string, plan {PLAN_STRUCT}, workout_html string, card_html string"
BAD_PLAN_ROW = "user_id bigint, date date, landed string, text string"

KEY_LIFT = "struct<exercise:string,sets:bigint,avg_weight:double,avg_reps:double,muscles:array<string>>"
SUMMARY = (
    "struct<date:string,had_workout:boolean,focus:string,volume_sets:map<string,bigint>,total_sets:bigint,"
    f"total_reps:bigint,estimated_volume:double,key_lifts:array<{KEY_LIFT}>,notes:string>"
)
PAYLOAD = (
    "date_for_plan string, sleep_last_night struct<hours:double,score:int,resting_hr:int>, bodyweight double, "
    f"week_volume map<string,bigint>, recent_workouts array<{SUMMARY}>, last_workout_summary {SUMMARY}, "
    "low_sleep_flag boolean"
)

# --- tables -----------------------------------------------------------------------------

# ``source`` says which landed file a day came from, in the order in which they count.
SERIES = "user_id bigint, date date, metric string, value string, seq bigint, source string"
WORKOUTS = "user_id bigint, date date, title string, duration string, seq bigint, source string"
SETS = (
    "user_id bigint, date date, pos bigint, exercise string, set_type string, weight_lbs string, reps string, "
    "distance_miles string, duration_seconds string, rpe string, notes string, source string"
)
DAILY = (
    "user_id bigint, date date, steps bigint, distance double, total_calories_burned bigint, sleep_hours double, "
    "sleep_score int, workout_title string, total_workout_duration string, calories_burned_from_workout bigint, "
    "calories_burned_from_steps bigint, resting_heart_rate int, bodyweight double"
)
AVERAGES = (
    "user_id bigint, avg_steps double, avg_resting_hr double, avg_sleep_hours double, "
    "avg_workout_duration_minutes double, avg_calories_burned double"
)
DASHBOARD = (
    "user_id bigint, date date, steps bigint, distance double, wearable_calories bigint, workout_calories double, "
    "total_calories bigint, sleep_hours double, sleep_score int, workout_title string, total_sets bigint, total_reps bigint, "
    "total_weight_lifted double, steps_rolling double, sleep_hours_rolling double, total_calories_rolling double"
)
SUMMARIES = f"user_id bigint, date date, summary {SUMMARY}"
# ``date`` is the Monday of the week; a week is one partition, whichever months it lies in.
WEEKS = "user_id bigint, date date, muscle string, sets bigint, volume double"
FEED = "user_id bigint, date date, metric_type string, label string, value string"

DAY = ["user_id", "date"]
