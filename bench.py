"""Times the headline queries: one warm-up run, then the median of three, each evaluated completely."""

from __future__ import annotations

import contextlib
import json
import os
import statistics
import sys
import time

HEADLINE = [
    "league_table",
    "standings",
    "global_ranking",
    "live_matches",
    "points_race",
    "rolling_form",
    "rolling_form_in_ranges",
    "scd1_matches",
    "scd2_standings",
    "dim_teams",
    "dim_matchdays",
    "stadium_weather",
    "top_scorers",
    "event_scorers",
    "match_events",
    "match_stats",
    "replay_schedule",
    "infer_rounds",
    "match_feed",
    "contract_violations",
    "contract_gate",
    "quality_report",
    "insert_new_keys",
    "entity_documents",
    "stream_counts_by_type",
    "stream_latest_state",
]


def run(spark, query, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from leaguelake.session import local_session

    with contextlib.redirect_stdout(sys.stderr):
        spark = local_session(cores)
        from leaguelake.queries import QUERIES

        times = {}
        for name in [n for n in HEADLINE if n in QUERIES and (len(sys.argv) == 1 or n in sys.argv[1:])]:
            run(spark, QUERIES[name], sf_dir)
            times[name] = round(statistics.median(run(spark, QUERIES[name], sf_dir) for _ in range(runs)), 3)
            print(name, times[name], file=sys.stderr, flush=True)
        spark.stop()
    result = {
        "metric": "headline queries, sum of warm medians",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
