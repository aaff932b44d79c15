"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Each query is planned, run and written to the no-op sink: one cold run, then the median of three.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from daylog.session import local_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "flatten_series daily_pivot upsert_new_wins insert_if_absent workouts_first_session sets_effective_weight "
    "workout_calories_day combine_daily averages exercise_stats muscle_sets_day workout_focus key_lifts_top3 "
    "workout_notes recent_workouts week_volume payload_flat dashboard_day rolling7 weekly_sets_30d "
    "weekly_weight_ranked progress_rolling3 set_numbers workout_text metric_feed plan_json_extract plan_html"
).split()


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    warm_runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cores, "daylog-bench")
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(seconds(spark, name, sf_dir), 3)
        warm[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(warm_runs)), 3)
    spark.stop()
    line = {
        "metric": "headline queries, sum of warm medians",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "cores": cores,
    }
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
