"""DuckDB counterparts of the queries, written from the tables' own columns."""

from __future__ import annotations

VIEWS = """
WITH b_series AS (
  SELECT user_id, CAST(ts AS DATE) AS date, event_id AS seq, 'steps' AS metric, trunc(value * 100) AS value
  FROM events WHERE event_type = 'view'
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), event_id, 'distance', value FROM events WHERE event_type = 'click'
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), event_id, 'weight', CAST(json_extract_string(props, '$.k') AS DOUBLE) + 100
  FROM events WHERE event_type = 'click'
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), event_id, 'calories_out', trunc(value * 40) FROM events WHERE event_type = 'purchase'
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), event_id, 'sleep_duration', trunc(value * 500000) FROM events WHERE event_type = 'signup'
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), event_id, 'sleep_efficiency', CAST(json_extract_string(props, '$.k') AS DOUBLE)
  FROM events WHERE event_type = 'signup'
  UNION ALL
  SELECT user_id, CAST(ts AS DATE), event_id, 'heart', trunc(value) FROM events WHERE event_type = 'error'
),
b_wide AS (
  SELECT user_id, date,
    max_by(value, seq) FILTER (metric = 'steps') AS steps,
    max_by(value, seq) FILTER (metric = 'distance') AS distance,
    max_by(value, seq) FILTER (metric = 'calories_out') AS calories_out,
    max_by(value, seq) FILTER (metric = 'sleep_duration') AS sleep_duration,
    max_by(value, seq) FILTER (metric = 'sleep_efficiency') AS sleep_efficiency,
    max_by(value, seq) FILTER (metric = 'heart') AS heart,
    max_by(value, seq) FILTER (metric = 'weight') AS weight
  FROM b_series GROUP BY user_id, date
),
b_sessions AS (
  SELECT o_custkey // 10 AS user_id, DATE '2023-11-20' + CAST(o_orderkey % 71 AS INTEGER) AS date,
    o_orderpriority AS title, CAST(trunc(o_totalprice) AS BIGINT) % 150 AS minutes, o_orderkey AS seq
  FROM orders
),
b_workouts AS (
  SELECT user_id, date, min_by(title, seq) AS title,
    min_by(CAST(minutes // 60 AS VARCHAR) || ':' || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0'), seq) AS duration,
    min(seq) AS seq
  FROM b_sessions GROUP BY user_id, date
),
b_dim AS (
  SELECT DISTINCT p_name AS exercise,
    CASE WHEN p_name NOT LIKE '%gizmo' THEN string_split(p_name, ' ') ELSE CAST([] AS VARCHAR[]) END AS muscles,
    CASE WHEN p_name < 'm' THEN CAST(4 + length(p_name) % 5 AS DOUBLE) ELSE 5.0 END AS met
  FROM part
),
b_raw AS (
  SELECT o_custkey // 10 AS user_id, DATE '2023-11-20' + CAST(o_orderkey % 71 AS INTEGER) AS date,
    l_orderkey * 8 + l_linenumber AS pos, l_partkey AS tie, p_name AS exercise, l_returnflag AS set_type,
    CASE WHEN l_tax <> 0 THEN l_extendedprice ELSE 0 END AS raw_weight_lbs,
    CASE WHEN l_discount <> 0 THEN CAST(l_quantity AS INTEGER) ELSE 0 END AS reps0,
    CASE WHEN l_linenumber = 7 THEN CAST(l_quantity AS INTEGER) + 30 ELSE 0 END AS seconds,
    CASE WHEN l_linenumber = 1 AND l_tax <> 0 THEN l_tax END AS distance,
    CASE WHEN l_returnflag = 'R' THEN 'gear ' || l_linestatus
         WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN ' dip ' ELSE '' END AS notes
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
),
b_sets AS (
  SELECT r.*, nullif(reps0, 0) AS reps, d.muscles, d.met,
    CASE WHEN r.exercise LIKE '%bolt%' THEN raw_weight_lbs * 2 + 45
         WHEN r.exercise LIKE '%ring%' THEN 160.0 - raw_weight_lbs
         WHEN r.exercise LIKE '%gear%' OR notes LIKE '%gear%' THEN raw_weight_lbs * 2
         WHEN r.exercise LIKE '%gizmo%' OR notes LIKE '%dip%' THEN 160.0
         ELSE raw_weight_lbs END AS weight_lbs,
    d.met * 3.5 * (160.0::DOUBLE * 0.453592::DOUBLE) / 200
      * CASE WHEN seconds <> 0 THEN seconds / 60 ELSE reps0 * 3 / 60 END AS calories
  FROM b_raw r JOIN b_dim d ON r.exercise = d.exercise
),
b_calories AS (
  SELECT user_id, date, CAST(trunc(sum(CAST(calories AS DECIMAL(18,6)))) AS BIGINT) AS workout_calories
  FROM b_sets GROUP BY user_id, date
),
b_trained AS (
  SELECT w.user_id, w.date, w.title, w.duration, c.workout_calories
  FROM b_workouts w LEFT JOIN b_calories c ON w.user_id = c.user_id AND w.date = c.date
),
b_daily AS (
  SELECT coalesce(a.user_id, t.user_id) AS user_id, coalesce(a.date, t.date) AS date,
    coalesce(CAST(steps AS BIGINT), 0) AS steps, coalesce(distance, 0.0) AS distance,
    coalesce(CAST(calories_out AS BIGINT), 0) + coalesce(workout_calories, 0) AS total_calories_burned,
    coalesce(sleep_duration, 0.0) / 1000 / 60 / 60 AS sleep_hours, CAST(sleep_efficiency AS INTEGER) AS sleep_score,
    title AS workout_title, coalesce(duration, '0:00') AS total_workout_duration,
    coalesce(workout_calories, 0) AS calories_burned_from_workout,
    coalesce(CAST(calories_out AS BIGINT), 0) AS calories_burned_from_steps,
    coalesce(CAST(heart AS INTEGER), 0) AS resting_heart_rate, coalesce(weight, 0.0) AS bodyweight
  FROM b_wide a FULL OUTER JOIN b_trained t ON a.user_id = t.user_id AND a.date = t.date
),
b_minutes AS (
  SELECT *, CAST(split_part(total_workout_duration, ':', 1) AS BIGINT) * 60
    + CAST(split_part(total_workout_duration, ':', 2) AS BIGINT) AS minutes
  FROM b_daily
),
b_averages AS (
  SELECT user_id,
    coalesce(avg(steps) FILTER (steps > 0), 0) AS avg_steps,
    coalesce(avg(resting_heart_rate) FILTER (resting_heart_rate > 0), 0) AS avg_resting_hr,
    coalesce(CAST(sum(CAST(sleep_hours AS DECIMAL(28,12))) FILTER (sleep_hours > 0) AS DOUBLE)
      / nullif(count(*) FILTER (sleep_hours > 0), 0), 0) AS avg_sleep_hours,
    coalesce(avg(minutes) FILTER (minutes > 0), 0) AS avg_workout_duration_minutes,
    coalesce(avg(total_calories_burned) FILTER (total_calories_burned > 0 AND calories_burned_from_steps <> 0), 0)
      AS avg_calories_burned
  FROM b_minutes GROUP BY user_id
),
b_set_muscle AS (
  SELECT s.*, u.muscle, u.place
  FROM b_sets s, (SELECT exercise AS dim_exercise, unnest(muscles) AS muscle, generate_subscripts(muscles, 1) AS place FROM b_dim) u
  WHERE s.exercise = u.dim_exercise
),
b_exercise AS (
  SELECT user_id, date, exercise, count(*) AS sets, CAST(sum(reps0) AS BIGINT) AS reps_sum,
    CAST(sum(CAST(weight_lbs AS DECIMAL(18,6))) FILTER (weight_lbs <> 0) AS DOUBLE)
      / nullif(count(*) FILTER (weight_lbs <> 0), 0) AS avg_weight,
    CAST(sum(reps0) AS DOUBLE) / count(*) AS avg_reps,
    min(pos) AS first_pos, any_value(muscles) AS muscles
  FROM b_sets GROUP BY user_id, date, exercise
),
b_scored AS (
  SELECT *, coalesce(avg_weight, 0.0) * avg_reps * sets AS score FROM b_exercise
),
b_totals AS (
  SELECT user_id, date, count(*) AS total_sets, CAST(sum(reps0) AS BIGINT) AS total_reps,
    CAST(format('{:.1f}', CAST(sum(CAST(weight_lbs * reps0 AS DECIMAL(18,6))) AS DOUBLE)) AS DOUBLE) AS estimated_volume
  FROM b_sets GROUP BY user_id, date
),
b_muscle AS (
  SELECT user_id, date, muscle, count(*) AS sets, min((first_pos, exercise, pos, place)) AS met_at
  FROM (SELECT m.*, min(pos) OVER (PARTITION BY user_id, date, exercise) AS first_pos FROM b_set_muscle m)
  GROUP BY user_id, date, muscle
),
b_top AS (
  SELECT user_id, date, muscle AS top_muscle FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY sets DESC, met_at) AS rn FROM b_muscle
  ) WHERE rn = 1
),
b_days AS (SELECT DISTINCT user_id, date FROM b_sets),
b_note_rows AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY first_pos, exercise, pos, notes) AS rn
  FROM (SELECT s.*, min(pos) OVER (PARTITION BY user_id, date, exercise) AS first_pos FROM b_sets s)
  WHERE notes <> ''
),
b_notes AS (
  SELECT user_id, date, string_agg(trim(notes), ' | ' ORDER BY rn) AS notes FROM b_note_rows
  WHERE rn <= 5 GROUP BY user_id, date
),
b_lifts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY score DESC, first_pos, exercise) AS rank FROM b_scored
  ) WHERE rank <= 3
),
b_summary AS (
  SELECT t.user_id, t.date, coalesce(top_muscle, 'other') AS focus, coalesce(v.volume_sets, '') AS volume_sets,
    total_sets, total_reps, estimated_volume, k.key_lifts, coalesce(n.notes, '') AS notes
  FROM b_totals t
  LEFT JOIN b_top p ON t.user_id = p.user_id AND t.date = p.date
  LEFT JOIN (SELECT user_id, date, string_agg(muscle || '=' || sets, ',' ORDER BY muscle) AS volume_sets
             FROM b_muscle GROUP BY user_id, date) v ON t.user_id = v.user_id AND t.date = v.date
  LEFT JOIN (SELECT user_id, date, string_agg(exercise, ',' ORDER BY rank) AS key_lifts
             FROM b_lifts GROUP BY user_id, date) k ON t.user_id = k.user_id AND t.date = k.date
  LEFT JOIN b_notes n ON t.user_id = n.user_id AND t.date = n.date
),
b_numbered AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, date, exercise
      ORDER BY pos, tie, weight_lbs, reps NULLS FIRST, notes) AS set_number,
    min(pos) OVER (PARTITION BY user_id, date, exercise) AS first_pos
  FROM b_sets
),
b_last_note AS (
  SELECT user_id, date, exercise, notes AS note FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, date, exercise ORDER BY
      pos DESC, tie DESC, weight_lbs DESC, reps DESC NULLS LAST, notes DESC) AS rn
    FROM b_sets WHERE notes <> ''
  ) WHERE rn = 1
),
b_blocks AS (
  SELECT s.user_id, s.date, s.exercise, s.first_pos,
    s.exercise || coalesce(chr(10) || '"' || any_value(n.note) || '"', '') || chr(10)
    || string_agg('Set ' || set_number || ': ' || CASE
         WHEN weight_lbs <> 0 THEN CAST(CAST(trunc(weight_lbs) AS BIGINT) AS VARCHAR) || ' lbs x ' || coalesce(CAST(reps AS VARCHAR), 'None')
         ELSE coalesce(CAST(reps AS VARCHAR), 'None') || ' reps' END, chr(10) ORDER BY set_number) AS text
  FROM b_numbered s LEFT JOIN b_last_note n
    ON s.user_id = n.user_id AND s.date = n.date AND s.exercise = n.exercise
  GROUP BY s.user_id, s.date, s.exercise, s.first_pos
),
b_text AS (
  SELECT user_id, date, string_agg(text, chr(10) || chr(10) ORDER BY first_pos, exercise) AS text
  FROM b_blocks GROUP BY user_id, date
),
b_feed AS (
  SELECT user_id, date, 'Steps' AS metric_type, '🦶 ' || format('{:,}', steps) AS label, CAST(steps AS VARCHAR) AS value
  FROM b_daily WHERE steps <> 0
  UNION ALL
  SELECT user_id, date, 'Sleep', '🛏️ ' || CAST(trunc(sleep_hours) AS BIGINT) || ' hr '
    || CAST(round_even((sleep_hours - trunc(sleep_hours)) * 60, 0) AS BIGINT) || ' min',
    CAST(CAST(format('{:.2f}', sleep_hours) AS DOUBLE) AS VARCHAR)
  FROM b_daily WHERE sleep_hours <> 0
  UNION ALL
  SELECT user_id, date, 'Calories', '🔥 ' || CASE
      WHEN total_calories_burned >= 1000000 THEN format('{:.1f}', total_calories_burned / 1000000) || 'M'
      WHEN total_calories_burned >= 1000 THEN format('{:.1f}', total_calories_burned / 1000) || 'k'
      ELSE CAST(total_calories_burned AS VARCHAR) END || ' cal', CAST(total_calories_burned AS VARCHAR)
  FROM b_daily WHERE total_calories_burned <> 0
  UNION ALL
  SELECT user_id, date, 'Heart Rate', '💓 ' || resting_heart_rate || ' BPM', CAST(resting_heart_rate AS VARCHAR)
  FROM b_daily WHERE resting_heart_rate <> 0
  UNION ALL
  SELECT user_id, date, 'Weight', '🍪 ' || CAST(bodyweight AS VARCHAR) || ' lbs', CAST(bodyweight AS VARCHAR)
  FROM b_daily WHERE bodyweight <> 0
  UNION ALL
  SELECT d.user_id, d.date, 'Workout', '🏋 ' || total_workout_duration, coalesce(t.text, '')
  FROM b_daily d LEFT JOIN b_text t ON d.user_id = t.user_id AND d.date = t.date
  WHERE total_workout_duration <> '0:00'
),
b_plans AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS date, event_type AS kind, json_extract_string(props, '$.k') AS k,
    event_type IN ('view', 'click', 'purchase') AS is_full
  FROM events WHERE event_type <> 'signup'
),
b_plan AS (
  SELECT event_id, date,
    CASE WHEN is_full THEN kind ELSE 'easy ' || k END AS day_focus,
    is_full, k, CASE WHEN kind = 'click' THEN k || '-100' ELSE k END AS target
  FROM b_plans
)
"""

SIX = "CAST(format('{{:.6f}}', CAST({0} AS DOUBLE)) AS DOUBLE) AS {1}"


def six(name: str, expression: str | None = None) -> str:
    return SIX.format(expression or name, name)


POINTS = """
, points AS (
  SELECT user_id, CAST(ts AS DATE) AS date, event_id,
    CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) AS whole, json_extract_string(props, '$.k') AS k, event_type AS kind
  FROM events
), flat AS (
  SELECT user_id, date, event_id, {steps} AS metric, whole AS value FROM points WHERE kind = 'view'
  UNION ALL SELECT user_id, date, event_id, 'distance', whole FROM points WHERE kind = 'click'
  UNION ALL SELECT user_id, date, event_id, {calories}, whole FROM points WHERE kind = 'purchase'
  UNION ALL SELECT user_id, date, event_id, 'active_minutes_very', whole FROM points WHERE kind = 'error'
  UNION ALL SELECT user_id, date, event_id, 'active_minutes_light', whole FROM points WHERE kind = 'error'
  UNION ALL SELECT user_id, date, event_id, 'sleep_duration', whole FROM points WHERE kind = 'signup' AND k <> '0'
  UNION ALL SELECT user_id, date, event_id, 'sleep_efficiency', k FROM points WHERE kind = 'signup' AND k <> '0'
  UNION ALL SELECT user_id, date, event_id, 'sleep_start', CAST(date AS VARCHAR) || 'T23:00:00'
    FROM points WHERE kind = 'signup' AND k <> '0'
  UNION ALL SELECT user_id, date, event_id, 'sleep_end', NULL FROM points WHERE kind = 'signup' AND k <> '0'
), latest AS (
  SELECT user_id, date, metric, value, event_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, date, metric ORDER BY event_id DESC) AS rn FROM flat
  ) WHERE rn = 1
)
"""
BARE = POINTS.format(steps="'steps'", calories="'calories_out'")
QUALIFIED = POINTS.format(steps="'steps_activities-steps'", calories="'calories_out_activities-calories'")

FEED_SELECT = "SELECT user_id, date, metric_type, label, value FROM b_feed"
CHARTED = """, charted AS (
  SELECT user_id, date, steps, sleep_hours, total_calories_burned AS total_calories FROM b_daily
)"""
WEEKLY = """, weekly AS (
  SELECT user_id, CAST(date_trunc('week', date) AS DATE) AS week, muscle, count(*) AS sets,
    CAST(sum(CAST(weight_lbs * reps0 AS DECIMAL(18,6))) AS DOUBLE) AS volume
  FROM b_set_muscle GROUP BY ALL
)"""
MEAN_SLEEP = """CAST(sum(CAST(sleep_hours AS DECIMAL(28,12))) FILTER (sleep_hours <> 0) AS DOUBLE)
      / nullif(count(*) FILTER (sleep_hours <> 0), 0)"""
SUMMARY_COLUMNS = (
    "user_id, date, recency, focus, volume_sets, total_sets, total_reps, estimated_volume, key_lifts, notes"
)

BODIES: dict[str, str] = {
    "flatten_series": BARE + "SELECT user_id, date, metric, value FROM latest",
    "flatten_legacy_series": QUALIFIED
    + """SELECT user_id, date, metric, value FROM latest l
    WHERE event_id = (SELECT max(event_id) FROM flat f WHERE f.user_id = l.user_id AND f.date = l.date)""",
    "basic_series_only": QUALIFIED
    + """SELECT user_id, date, regexp_extract(metric, '^(steps|distance|calories_out)', 1) AS metric, value FROM latest
    WHERE metric IN ('steps_activities-steps', 'distance', 'calories_out_activities-calories')""",
    "typed_day_from_documents": BARE
    + f"""SELECT user_id, date, coalesce(max(CAST(value AS BIGINT)) FILTER (metric = 'steps'), 0) AS steps,
      coalesce(max(CAST(value AS DOUBLE)) FILTER (metric = 'distance'), 0.0) AS distance,
      coalesce(max(CAST(value AS BIGINT)) FILTER (metric = 'calories_out'), 0) AS calories_burned_from_steps,
      {six("sleep_hours", "coalesce(max(CAST(value AS DOUBLE)) FILTER (metric = 'sleep_duration'), 0.0) / 1000 / 60 / 60")},
      max(CAST(value AS INTEGER)) FILTER (metric = 'sleep_efficiency') AS sleep_score
    FROM (SELECT * FROM latest WHERE metric IN ('steps', 'distance', 'calories_out', 'sleep_duration', 'sleep_efficiency'))
    GROUP BY user_id, date""",
    "unreadable_series": """SELECT user_id, CAST(ts AS DATE) AS date, 'steps' AS metric, format('{:.2f}', value) AS value,
      event_id AS seq FROM events WHERE event_type = 'view'""",
    "daily_pivot": "SELECT * FROM b_wide",
    "sleep_last_wins": """SELECT user_id, date, metric, max_by(value, seq) AS value, max(seq) AS seq FROM b_series
    WHERE metric IN ('sleep_duration', 'sleep_efficiency') GROUP BY user_id, date, metric""",
    "upsert_new_wins": """SELECT user_id, date, seq, metric, value FROM b_series s WHERE metric = 'heart' OR NOT EXISTS (
      SELECT 1 FROM b_series n WHERE n.metric = 'heart' AND n.user_id = s.user_id AND n.date = s.date)""",
    "insert_if_absent": """, sessions AS (
      SELECT user_id, date, title, seq, title IN ('1-URGENT', '2-HIGH') AS stored,
        CAST(minutes // 60 AS VARCHAR) || ':' || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0') AS duration FROM b_sessions
    ), picked AS (
      SELECT *, row_number() OVER (PARTITION BY user_id, date ORDER BY stored DESC, seq DESC) AS rn FROM sessions
    ) SELECT user_id, date, title, duration, seq FROM picked WHERE rn = 1""",
    "series_union": """SELECT user_id, date, count(*) AS n_rows, count(DISTINCT metric) AS n_metrics FROM b_series
    GROUP BY user_id, date""",
    "set_log_parsed": """SELECT o_custkey AS user_id, CAST(o_orderdate + to_minutes(o_orderkey % 1440) AS DATE) AS date,
      o_orderkey AS pos, o_orderpriority AS title,
      CAST((CAST(trunc(o_totalprice) AS BIGINT) % 200) // 60 AS VARCHAR) || ':'
        || lpad(CAST((CAST(trunc(o_totalprice) AS BIGINT) % 200) % 60 AS VARCHAR), 2, '0') AS duration,
      o_orderstatus AS exercise, CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey AS VARCHAR) END AS weight_lbs,
      'normal' AS set_type,
      CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 100 AS VARCHAR) END AS reps,
      CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 100 AS VARCHAR) END AS distance_miles,
      CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 100 AS VARCHAR) END AS duration_seconds,
      CASE WHEN o_orderkey % 2 <> 0 THEN CAST(o_orderkey % 100 AS VARCHAR) END AS rpe,
      CASE WHEN o_orderstatus = 'P' THEN 'steady' ELSE '' END AS notes FROM orders""",
    "workouts_first_session": "SELECT user_id, date, title, duration, seq FROM b_workouts",
    "overlapping_exports": """, export AS (
      SELECT user_id, date, title, minutes, seq, '2024-01-01 b.csv' AS source FROM b_sessions WHERE seq % 3 <> 0
      UNION ALL SELECT user_id, date, title, minutes, seq, '2024-02-01 a.csv' FROM b_sessions
    ), won AS (
      SELECT *, min(source) OVER (PARTITION BY user_id, date) AS best FROM export
    ) SELECT user_id, date, min_by(title, seq) AS title,
      min_by(CAST(minutes // 60 AS VARCHAR) || ':' || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0'), seq) AS duration,
      min(seq) AS seq, any_value(source) AS source, count(*) AS n_sets FROM won WHERE source = best GROUP BY user_id, date""",
    "legacy_sessions": """SELECT user_id, date, min_by(title, seq) AS title, '0:00' AS duration, min(seq) AS seq, count(*) AS n_sets,
      count(*) FILTER (WHERE seq % 7 <> 0) AS n_numbers, count(*) FILTER (WHERE seq % 7 <> 0) AS n_weighted
      FROM b_sessions WHERE seq % 11 <> 0 GROUP BY user_id, date""",
    "workouts_last_record": """SELECT user_id, date, max_by(title, seq) AS title,
      max_by(CAST(minutes // 60 AS VARCHAR) || ':' || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0'), seq) AS duration,
      max(seq) AS seq FROM b_sessions GROUP BY user_id, date""",
    "load_audit_sets": """SELECT 'sets' AS table_name, count(*) AS n_rows, count(DISTINCT user_id) AS n_users,
      count(DISTINCT (user_id, date)) AS n_days, min(date) AS first_date, max(date) AS last_date FROM b_raw""",
    "date_preview": """, days AS (SELECT DISTINCT user_id, date FROM b_series), placed AS (
      SELECT user_id, date, row_number() OVER (PARTITION BY user_id ORDER BY date) AS up,
        row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS down FROM days
    ) SELECT user_id, date, CAST(up AS INTEGER) AS place, 'head' AS "end" FROM placed WHERE up <= 5
    UNION ALL SELECT user_id, date, CAST(down AS INTEGER), 'tail' FROM placed WHERE down <= 5""",
    "sets_effective_weight": """SELECT user_id, date, pos, tie, exercise, set_type, raw_weight_lbs, weight_lbs, reps,
      distance, notes, array_to_string(muscles, ',') AS muscles FROM b_sets""",
    "sets_calories": f"SELECT user_id, date, pos, tie, raw_weight_lbs, {six('calories')} FROM b_sets",
    "workout_calories_day": "SELECT user_id, date, workout_calories AS calories_burned_from_workout FROM b_calories",
    "unmapped_exercises": "SELECT exercise, count(*) AS n_sets FROM b_raw WHERE exercise LIKE '%gizmo' GROUP BY exercise",
    "combine_daily": f"SELECT * EXCLUDE (sleep_hours), {six('sleep_hours')} FROM b_daily",
    "averages": f"""SELECT user_id, {six("avg_steps")}, {six("avg_resting_hr")}, {six("avg_sleep_hours")},
      {six("avg_workout_duration_minutes")}, {six("avg_calories_burned")} FROM b_averages""",
    "averages_text": """, spans AS (
      SELECT *, avg_sleep_hours * 60 AS s, avg_workout_duration_minutes AS w FROM b_averages
    ) SELECT user_id, 'steps' AS block, 'Average Daily Steps: ' || CAST(round_even(avg_steps, 0) AS BIGINT) AS text FROM spans
    UNION ALL SELECT user_id, 'resting_hr', 'Average Resting Heart Rate: ' || CAST(round_even(avg_resting_hr, 0) AS BIGINT) FROM spans
    UNION ALL SELECT user_id, 'sleep', 'Average Sleep: ' || CASE WHEN s >= 60 THEN CAST(floor(s / 60) AS BIGINT) || ' hr ' ELSE '' END
      || CAST(round_even(s - 60 * floor(s / 60), 0) AS BIGINT) || ' min' FROM spans
    UNION ALL SELECT user_id, 'workout_duration', 'Average Workout Duration: '
      || CASE WHEN w >= 60 THEN CAST(floor(w / 60) AS BIGINT) || ' hr ' ELSE '' END
      || CAST(round_even(w - 60 * floor(w / 60), 0) AS BIGINT) || ' min' FROM spans
    UNION ALL SELECT user_id, 'calories', 'Average Calories Burned: ' || CAST(round_even(avg_calories_burned, 0) AS BIGINT) FROM spans""",
    "averages_report": """, spans AS (SELECT *, avg_workout_duration_minutes AS w FROM b_averages)
    SELECT user_id, 'steps' AS block, '- Steps: ' || format('{:.0f}', avg_steps) AS text FROM spans
    UNION ALL SELECT user_id, 'resting_hr', '- Resting HR: ' || format('{:.1f}', avg_resting_hr) || ' bpm' FROM spans
    UNION ALL SELECT user_id, 'sleep', '- Sleep Duration: ' || format('{:.2f}', avg_sleep_hours) || ' hours' FROM spans
    UNION ALL SELECT user_id, 'workout_duration', '- Workout Duration: ' || CAST(floor(w / 60) AS BIGINT) || ' hr '
      || CAST(trunc(w - 60 * floor(w / 60)) AS BIGINT) || ' min' FROM spans
    UNION ALL SELECT user_id, 'calories', '- Calories Burned: ' || format('{:.0f}', avg_calories_burned) FROM spans""",
    "exercise_stats": f"""SELECT user_id, date, exercise, sets, reps_sum, {six("avg_weight")}, {six("avg_reps")},
      CAST(format('{{:.2f}}', score) AS DOUBLE) AS score, array_to_string(list_sort(muscles), ',') AS muscles FROM b_scored""",
    "day_totals": "SELECT * FROM b_totals",
    "muscle_sets_day": "SELECT user_id, date, muscle, sets FROM b_muscle",
    "workout_focus": """SELECT d.user_id, d.date, CASE WHEN top_muscle IS NULL THEN 'other'
      WHEN top_muscle IN ('red', 'blue', 'bolt') THEN 'push' WHEN top_muscle IN ('hot', 'cold', 'gear') THEN 'pull'
      WHEN top_muscle IN ('plate', 'rod') THEN 'legs' ELSE top_muscle END AS focus
    FROM b_days d LEFT JOIN b_top t ON d.user_id = t.user_id AND d.date = t.date""",
    "key_lifts_top3": """SELECT user_id, date, CAST(rank AS INTEGER) AS rank, exercise, sets, CAST(format('{:.1f}', avg_weight) AS DOUBLE) AS avg_weight,
      CAST(format('{:.1f}', avg_reps) AS DOUBLE) AS avg_reps, array_to_string(list_sort(muscles), ',') AS muscles FROM b_lifts""",
    "workout_notes": "SELECT * FROM b_notes",
    "recent_workouts": f"""SELECT {SUMMARY_COLUMNS} FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS INTEGER) AS recency FROM b_summary) WHERE recency <= 3""",
    "oldest_workouts": f"""SELECT {SUMMARY_COLUMNS} FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY date) AS INTEGER) AS recency FROM b_summary) WHERE recency <= 2""",
    "set_numbers": "SELECT user_id, date, exercise, pos, tie, weight_lbs, set_number FROM b_numbered",
    "exercise_last_note": """SELECT s.user_id, s.date, s.exercise, any_value(n.note) AS note, count(*) AS n_sets
    FROM b_sets s LEFT JOIN b_last_note n ON s.user_id = n.user_id AND s.date = n.date AND s.exercise = n.exercise
    GROUP BY s.user_id, s.date, s.exercise""",
    "workout_text": "SELECT user_id, date, text FROM b_text",
    "week_volume": """SELECT user_id, muscle, count(*) AS sets FROM b_set_muscle
    WHERE isoyear(date) = 2024 AND weekofyear(date) = 3 GROUP BY user_id, muscle""",
    "prior_day_lookup": f"""SELECT coalesce(a.user_id, c.user_id) AS user_id, {six("hours", "a.sleep_hours")}, a.sleep_score AS score,
      a.resting_heart_rate AS resting_hr, coalesce(nullif(a.bodyweight, 0), c.bodyweight) AS bodyweight
    FROM (SELECT * FROM b_daily WHERE date = DATE '2024-01-16') a
    FULL OUTER JOIN (SELECT * FROM b_daily WHERE date = DATE '2024-01-17') c ON a.user_id = c.user_id""",
    "low_sleep_flag": "SELECT user_id, date, sleep_hours < 6.0 AS low_sleep FROM b_daily",
    "payload_flat": f""", users AS (SELECT DISTINCT user_id FROM b_daily), week AS (
      SELECT user_id, count(*) AS week_muscles, CAST(sum(n) AS BIGINT) AS week_sets,
        string_agg(muscle || '=' || n, ',' ORDER BY muscle) AS week_text
      FROM (SELECT user_id, muscle, count(*) AS n FROM b_set_muscle
            WHERE date BETWEEN DATE '2024-01-15' AND DATE '2024-01-21' GROUP BY user_id, muscle) GROUP BY user_id
    ), recent AS (
      SELECT user_id, string_agg(date || '|' || focus || '|' || volume_sets || '|' || total_sets || '|' || total_reps || '|'
          || format('{{:.1f}}', estimated_volume) || '|' || coalesce(key_lifts, '') || '|' || notes, ';' ORDER BY r) AS recent_text,
        count(*) AS n_recent, min_by(CAST(date AS VARCHAR), r) AS last_date, min_by(total_sets, r) AS last_sets,
        string_agg(CAST(date AS VARCHAR), ',' ORDER BY r) AS recent_dates
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY date DESC) AS r FROM b_summary) WHERE r <= 3 GROUP BY user_id
    ) SELECT u.user_id, '2024-01-17' AS date_for_plan, {six("hours", "a.sleep_hours")}, a.sleep_score AS score,
      coalesce(nullif(a.bodyweight, 0), c.bodyweight) AS bodyweight,
      CAST(coalesce(week_muscles, 0) AS INTEGER) AS week_muscles, coalesce(week_sets, 0) AS week_sets,
      CAST(coalesce(n_recent, 0) AS INTEGER) AS n_recent, n_recent IS NOT NULL AS had_workout, last_date, last_sets,
      coalesce(recent_dates, '') AS recent_dates, coalesce(week_text, '') AS week_text, coalesce(recent_text, '') AS recent_text,
      coalesce(a.sleep_hours < 6.0, false) AS low_sleep_flag
    FROM users u LEFT JOIN (SELECT * FROM b_daily WHERE date = DATE '2024-01-16') a ON u.user_id = a.user_id
    LEFT JOIN (SELECT * FROM b_daily WHERE date = DATE '2024-01-17') c ON u.user_id = c.user_id
    LEFT JOIN week w ON u.user_id = w.user_id LEFT JOIN recent r ON u.user_id = r.user_id""",
    "dashboard_day": f""", totals AS (
      SELECT user_id, date, count(*) AS total_sets, CAST(sum(reps0) AS BIGINT) AS total_reps,
        CAST(sum(CAST(weight_lbs * reps0 AS DECIMAL(18,6))) AS DOUBLE) AS total_weight_lifted,
        CAST(format('{{:.1f}}', CAST(sum(CAST(met * 3.5 * 72.0::DOUBLE / 200 * greatest(0.3::DOUBLE, reps0 / 20)
          AS DECIMAL(18,6))) AS DOUBLE)) AS DOUBLE) AS fallback
      FROM b_sets GROUP BY user_id, date
    ) SELECT d.user_id, d.date, steps, distance, calories_burned_from_steps AS wearable_calories,
      coalesce(nullif(CAST(calories_burned_from_workout AS DOUBLE), 0), fallback, 0.0) AS workout_calories,
      total_calories_burned AS total_calories, {six("sleep_hours")}, sleep_score, workout_title,
      coalesce(total_sets, 0) AS total_sets, coalesce(total_reps, 0) AS total_reps,
      coalesce(total_weight_lifted, 0.0) AS total_weight_lifted
    FROM b_daily d LEFT JOIN totals t ON d.user_id = t.user_id AND d.date = t.date""",
    "fallback_calories": """SELECT user_id, date, count(*) AS total_sets,
      CAST(format('{:.1f}', CAST(sum(CAST(met * 3.5 * 72.0::DOUBLE / 200 * greatest(0.3::DOUBLE, reps0 / 20)
        AS DECIMAL(18,6))) AS DOUBLE)) AS DOUBLE) AS fallback_calories
    FROM b_sets GROUP BY user_id, date""",
    "rolling7": CHARTED
    + f""" SELECT user_id, date, {six("steps_rolling", "avg(steps) OVER w")},
      {six("sleep_hours_rolling", "avg(sleep_hours) OVER w")}, {six("total_calories_rolling", "avg(total_calories) OVER w")}
    FROM charted WINDOW w AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
    "global_mean_joined": CHARTED
    + f""" SELECT c.user_id, c.date, c.steps, {six("steps_total_average", "m.s")},
      {six("sleep_hours_total_average", "m.h")}, {six("total_calories_total_average", "m.c")}
    FROM charted c JOIN (SELECT user_id, avg(steps) AS s, CAST(sum(CAST(sleep_hours AS DECIMAL(28,12))) AS DOUBLE) / count(*) AS h, avg(total_calories) AS c
      FROM charted GROUP BY user_id) m ON c.user_id = m.user_id""",
    "nonzero_means": CHARTED
    + f""" SELECT user_id, {six("avg_steps", "avg(nullif(steps, 0))")}, {six("avg_sleep_hours", MEAN_SLEEP)},
      {six("avg_total_calories", "avg(nullif(total_calories, 0))")} FROM charted GROUP BY user_id""",
    "reference_labels": CHARTED
    + """ SELECT user_id, 'Avg Calories: ' || CAST(trunc(avg(nullif(total_calories, 0))) AS BIGINT) AS calories_label,
      'Avg Steps: ' || CAST(trunc(avg(nullif(steps, 0))) AS BIGINT) AS steps_label,
      'Avg Sleep: ' || format('{:.1f}', """ + MEAN_SLEEP + """) || 'h' AS sleep_label FROM charted GROUP BY user_id""",
    "valid_date_range": CHARTED
    + """ SELECT user_id, min(date) FILTER (steps <> 0) AS steps_from, max(date) FILTER (steps <> 0) AS steps_to,
      min(date) FILTER (sleep_hours <> 0) AS sleep_hours_from, max(date) FILTER (sleep_hours <> 0) AS sleep_hours_to,
      min(date) FILTER (total_calories > 100) AS total_calories_from, max(date) FILTER (total_calories > 100) AS total_calories_to
    FROM charted GROUP BY user_id""",
    "steps_bucket": """SELECT user_id, CASE WHEN avg(steps) >= 10000 THEN 'green' WHEN avg(steps) >= 5000 THEN 'orange'
      ELSE 'red' END AS colour FROM b_daily GROUP BY user_id""",
    "weekly_sets": WEEKLY + " SELECT user_id, week, muscle, sets FROM weekly",
    "weekly_sets_30d": """SELECT m.user_id, CAST(date_trunc('week', m.date) AS DATE) AS week, muscle, count(*) AS sets
    FROM b_set_muscle m JOIN (SELECT user_id, max(date) AS newest FROM b_set_muscle GROUP BY user_id) n
      ON m.user_id = n.user_id WHERE m.date >= n.newest - 30 GROUP BY ALL""",
    "weekly_weight_ranked": WEEKLY
    + """ SELECT user_id, week, muscle, volume AS total_weight,
      CAST(row_number() OVER (PARTITION BY user_id, week ORDER BY volume DESC, muscle) AS INTEGER) AS rank
    FROM weekly w WHERE week >= (SELECT max(week) FROM weekly n WHERE n.user_id = w.user_id) - 28""",
    "progress_rolling3": WEEKLY
    + f""" SELECT user_id, week, muscle, volume, {six("volume_rolling", "avg(volume) OVER t")}
    FROM weekly WHERE muscle IN ('red', 'hot', 'plate')
    WINDOW t AS (PARTITION BY user_id, muscle ORDER BY week ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "weekly_event_totals": """SELECT CAST(date_trunc('week', ts) AS DATE) AS week, user_id, count(*) AS n,
      CAST(sum(CAST(value AS DECIMAL(18,6))) AS DOUBLE) AS total FROM events GROUP BY ALL""",
    "metric_feed": FEED_SELECT,
    "feed_point_day": FEED_SELECT + " WHERE date = DATE '2024-01-17'",
    "feed_range": FEED_SELECT + " WHERE date BETWEEN DATE '2023-12-25' AND DATE '2024-01-20'",
    "date_spine_missing": """, spine AS (
      SELECT user_id, CAST(d AS DATE) AS date FROM (SELECT DISTINCT user_id FROM b_daily),
        generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-01-20', INTERVAL 1 DAY) g(d)
    ) SELECT user_id, date FROM spine s
    WHERE NOT EXISTS (SELECT 1 FROM b_daily d WHERE d.user_id = s.user_id AND d.date = s.date)""",
    "number_formats": """, n AS (SELECT *, l_extendedprice AS p, l_extendedprice * l_quantity AS pq FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
      CASE WHEN pq >= 1000000 THEN format('{:.1f}', pq / 1000000) || 'M' WHEN pq >= 1000 THEN format('{:.1f}', pq / 1000) || 'k'
        ELSE CAST(CAST(trunc(pq) AS BIGINT) AS VARCHAR) END AS short,
      format('{:,}', CAST(trunc(p) AS BIGINT)) AS thousands, CAST(format('{:.1f}', p / 8) AS DOUBLE) AS one_decimal,
      CAST(round_even(p / 2, 0) AS BIGINT) AS whole, format('{:.1f}', p / 4) AS fixed_1, CAST(p AS VARCHAR) AS float_text,
      CAST(format('{:.4f}', p * 0.453592::DOUBLE) AS DOUBLE) AS kg,
      CAST(format('{:.4f}', l_quantity * 0.621371::DOUBLE) AS DOUBLE) AS miles FROM n""",
    "duration_formats": """, m AS (
      SELECT *, CAST(trunc(o_totalprice) AS BIGINT) % 1500 AS minutes, o_totalprice / 1000 AS hm, o_totalprice / 50000 AS h FROM orders
    ) SELECT o_orderkey, CAST(minutes // 60 AS VARCHAR) || ':' || lpad(CAST(minutes % 60 AS VARCHAR), 2, '0') AS clock, minutes,
      CASE WHEN hm >= 60 THEN CAST(floor(hm / 60) AS BIGINT) || ' hr ' ELSE '' END
        || CAST(round_even(hm % 60, 0) AS BIGINT) || ' min' AS hours_minutes,
      CAST(trunc(h) AS BIGINT) || ' hr ' || CAST(round_even((h - trunc(h)) * 60, 0) AS BIGINT) || ' min' AS sleep FROM m""",
    "iso_weeks": """SELECT o_orderkey, isoyear(o_orderdate) AS iso_year, weekofyear(o_orderdate) AS iso_week,
      CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start FROM orders""",
    "plan_json_extract": """SELECT event_id, day_focus, CASE WHEN is_full THEN 2 ELSE 0 END AS n_warmup,
      CASE WHEN is_full THEN 'lift ' || k END AS lift, CASE WHEN is_full THEN '4' END AS sets,
      CASE WHEN is_full THEN target END AS target, CASE WHEN is_full THEN CAST(k AS INTEGER) END AS protein,
      CASE WHEN is_full THEN 'rest' END AS notes FROM b_plan""",
    "plan_unreadable": "SELECT event_id, 'no plan today' AS text FROM events WHERE event_type = 'signup'",
    "template_fill": """SELECT event_id, '<h2>' || CAST(date AS VARCHAR) || '</h2><p>' || day_focus || '</p><ul>'
      || CASE WHEN is_full THEN '<li>lift ' || k || '</li>' ELSE '' END || '</ul><p>'
      || CASE WHEN is_full THEN 'walk, row ' || k ELSE '' END || '</p><p>' || CASE WHEN is_full THEN 'rest' ELSE '' END
      || '</p>{{unset}}' AS page FROM b_plan""",
}


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _page(template: str, slots: dict[str, str]) -> str:
    """SQL that fills a page by nested replacement."""
    expression = _sql_text(template)
    for name, value in slots.items():
        expression = f"replace({expression}, {_sql_text('{{' + name + '}}')}, {value})"
    return expression


def _rendered() -> dict[str, str]:
    from daylog.plans.rendering import CARD_PAGE, MAIN_LIFT_PART, PROMPT, WORKOUT_PAGE

    def if_full(expression: str, other: str = "''") -> str:
        return f"CASE WHEN is_full THEN {expression} ELSE {other} END"

    lift = _page(
        MAIN_LIFT_PART,
        {"exercise": "'lift ' || k", "sets": "'4'", "reps_range": "'5-8'", "load": "target", "rpe_range": "'7'", "notes": "'slow'"},
    )
    warmup = "'<li>walk</li><li>row ' || k || '</li>'"
    workout = _page(
        WORKOUT_PAGE,
        {
            "focus": "day_focus",
            "notes": if_full("'rest'"),
            "warmup": if_full(warmup),
            "main_lifts": if_full(lift),
            "accessories": "''",
            "conditioning": if_full("'bike'"),
        },
    )
    lift_json = """'<li>{"exercise":"lift ' || k || '","sets":"4","reps_range":"5-8","target_weight_lbs":"' || target
      || '","rpe_range":"7","notes":"slow"}</li>'"""
    none = "'<li>None</li>'"
    card = _page(
        CARD_PAGE,
        {
            "focus": "day_focus",
            "main_lifts": if_full(lift_json, none),
            "accessories": none,
            "conditioning": if_full("'bike'", "'[]'"),
            "warmup": if_full(warmup, none),
            "notes": if_full("'rest'"),
        },
    )
    shown = "coalesce(CAST({0} AS VARCHAR), 'None')"
    prompt = _page(
        PROMPT,
        {
            "profile": "coalesce('Segment ' || c_mktsegment, '')",
            "hours": shown.format("a.sleep_hours"),
            "score": shown.format("a.sleep_score"),
            "resting_hr": shown.format("a.resting_heart_rate"),
            "bodyweight": shown.format("coalesce(nullif(a.bodyweight, 0), c.bodyweight)"),
            "week_volume": "'{}'",
            "recent_workouts": "'[]'",
            "last_workout": "CASE WHEN s.user_id IS NULL THEN '{\"had_workout\":false}' ELSE '{\"had_workout\":true}' END",
            "today": "'2024-01-17'",
        },
    )
    return {
        "plan_html": f"SELECT event_id, {workout} AS html FROM b_plan",
        "plan_card_html": f"SELECT event_id, {card} AS html FROM b_plan",
        "prompt_text": f"""SELECT u.user_id, {prompt} AS prompt FROM (SELECT DISTINCT user_id FROM b_daily) u
    LEFT JOIN (SELECT * FROM b_daily WHERE date = DATE '2024-01-16') a ON u.user_id = a.user_id
    LEFT JOIN (SELECT * FROM b_daily WHERE date = DATE '2024-01-17') c ON u.user_id = c.user_id
    LEFT JOIN (SELECT DISTINCT user_id FROM b_sets) s ON u.user_id = s.user_id
    LEFT JOIN customer ON c_custkey = u.user_id""",
    }


# Figures merged from months are those of one pass.
BODIES["averages_by_month"] = BODIES["averages"]
BODIES["nonzero_means_by_month"] = BODIES["nonzero_means"]
BODIES["valid_range_by_month"] = BODIES["valid_date_range"]
BODIES |= {
    "newest_days_after_update": """, per_day AS (
      SELECT DISTINCT o_custkey // 10 AS user_id, CAST(DATE '2023-11-20' + CAST(o_orderkey % 71 AS INTEGER) AS DATE) AS date FROM orders
    ) SELECT user_id, date, CAST(date AS VARCHAR) AS summary FROM per_day
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY date DESC) <= 8""",
    "nested_heart_rate": """SELECT user_id, CAST(ts AS DATE) AS date, event_id AS seq,
      CASE WHEN event_id % 4 = 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS value FROM events""",
    "malformed_sets_skipped": """, entries AS (
      SELECT *, 0 AS pos, o_orderpriority AS exercise FROM orders
      UNION ALL SELECT *, 1, CASE WHEN o_orderkey % 3 <> 0 THEN 'B' END FROM orders
      UNION ALL SELECT *, 2, CASE WHEN o_orderkey % 2 = 0 THEN 'C' END FROM orders
    ) SELECT o_custkey // 10 AS user_id, CAST(DATE '2023-11-20' + CAST(o_orderkey % 71 AS INTEGER) AS DATE) AS date,
      CAST(pos AS BIGINT) AS pos, exercise, o_totalprice AS weight_lbs, CAST(o_orderkey % 20 AS INTEGER) AS reps, '' AS notes, 0 AS n_muscles
    FROM entries WHERE exercise IS NOT NULL AND o_orderkey % 7 <> 0""",
}


def oracle_queries() -> dict[str, str]:
    return {name: VIEWS + body for name, body in {**BODIES, **_rendered()}.items()}
