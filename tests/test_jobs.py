"""The live and the batch path from landed files to gold tables."""

import datetime as dt
import json
from graphlib import CycleError
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from leaguelake.plans import graph, jobs

TEAMS = ["Arsenal FC", "AFC Bournemouth", "Chelsea FC", "Everton FC"]


def match(i, matchday, home, away, status, score=(None, None)):
    return {
        "id": i,
        "utcDate": f"2025-08-{matchday + 10:02d}T15:00:00Z",
        "status": status,
        "matchday": matchday,
        "homeTeam": {"id": home, "name": TEAMS[home]},
        "awayTeam": {"id": away, "name": TEAMS[away]},
        "score": {"winner": None, "fullTime": {"home": score[0], "away": score[1]}},
    }


def land(folder: Path, name: str, payload: dict) -> str:
    folder.mkdir(parents=True)
    (folder / f"{name}.json").write_text(json.dumps(payload, indent=1))
    return str(folder)


def at(text):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    first = [match(1, 1, 0, 1, "FINISHED", (2, 0)), match(2, 1, 2, 3, "IN_PLAY", (0, 0)), match(3, 2, 1, 2, "TIMED")]
    second = [
        match(2, 1, 2, 3, "FINISHED", (1, 1)),
        match(3, 2, 1, 2, "FINISHED", (0, 3)),
        {**match(4, 2, 3, 0, "TIMED"), "matchday": 99},
    ]
    lake = str(root / "lake")
    gates = [
        jobs.land_matches(
            spark, land(root / f"matches{n}", "m", {"matches": rows}), lake, at=at(f"2025-08-{11 + n} 18:00:00")
        ).first()
        for n, rows in enumerate([first, second])
    ]
    assert [(g.valid, g.records_checked, g.records_passed) for g in gates] == [(True, 3, 3), (False, 3, 2)]
    table = [
        {"position": p, "team": {"id": p, "name": t}, "playedGames": 2, "won": 1, "draw": 0, "lost": 1, "points": 3,
         "goalsFor": 2, "goalsAgainst": 1, "goalDifference": None}
        for p, t in enumerate(TEAMS, 1)
    ]
    payload = {"season": {"startDate": "2025-08-15"}, "standings": [{"type": "TOTAL", "table": table}]}
    jobs.land_standings(spark, land(root / "standings", "s", payload), lake, at("2025-08-12 18:00:00"))
    jobs.build_live_gold(spark, lake, at("2025-08-12 18:15:00"))
    return lake


def gold(spark, lake, name):
    return spark.read.parquet(f"{lake}/gold/{name}")


def test_live_state_and_history(spark, lake):
    state = {r.match_id: r for r in gold(spark, lake, "live_matches").collect()}
    assert {k: v.status for k, v in state.items()} == {"1": "FINISHED", "2": "FINISHED", "3": "FINISHED", "4": "SCHEDULED"}
    assert (state["3"].home_team, state["3"].away_team, state["3"].away_score) == ("Bournemouth", "Chelsea", 3)
    history = {r.match_id: (r.update_count, r.is_correction) for r in gold(spark, lake, "scd1_matches").collect()}
    assert history == {"1": (1, False), "2": (2, True), "3": (2, True), "4": (1, False)}


def test_race_teams_and_monitor(spark, lake):
    race = {(r.team_name, r.matchday): r.cumulative_points for r in gold(spark, lake, "points_race").collect()}
    assert race == {
        ("Arsenal", 1): 3, ("Bournemouth", 1): 0, ("Chelsea", 1): 1, ("Everton", 1): 1,
        ("Bournemouth", 2): 0, ("Chelsea", 2): 4,
    }
    teams = {r.team_name: (r.current_form, r.goal_difference, r.tier) for r in gold(spark, lake, "dim_teams").collect()}
    assert teams["Chelsea"] == ("DW", 1, "TITLE CONTENDER")
    monitor = gold(spark, lake, "live_match_monitor").first()
    assert (monitor.active_match_count, monitor.freshness_minutes, monitor.freshness_status) == (
        4, 15, "PASS_MATCHDAY_SLA",
    )


def test_quarantine_and_runs(spark, lake):
    bad = spark.read.parquet(f"{lake}/quarantine/live_matches").collect()
    assert [(r.match_id, r.violations[0].field) for r in bad] == [("4", "matchday")]
    runs = spark.read.parquet(f"{lake}/bronze/pipeline_runs").orderBy("created_at").collect()
    assert [(r.pipeline_name, r.status, r.rows_written) for r in runs] == [
        ("live_matches", "success", 3), ("live_matches", "success", 3), ("live_standings", "success", 4),
    ]
    landed = spark.read.parquet(f"{lake}/bronze/live_matches")
    assert [r.match_id for r in landed.filter("verdict = 'quarantined'").collect()] == ["4"]
    assert landed.filter("verdict = 'accepted'").count() == 5


def test_export_behind_the_gate(spark, lake, tmp_path):
    late = at("2025-08-20 18:00:00")
    assert not jobs.export_live(spark, lake, str(tmp_path / "late"), late)
    assert not (tmp_path / "late").exists()
    assert jobs.export_live(spark, lake, str(tmp_path / "now"), at("2025-08-12 18:15:00"))
    rows = spark.read.json(str(tmp_path / "now" / "live_matches")).collect()
    assert {r.match_id for r in rows} == {"1", "2", "3", "4"}
    assert spark.read.json(str(tmp_path / "now" / "standings")).count() == 4
    log = spark.read.parquet(f"{lake}/bronze/pipeline_runs").filter("pipeline_name = 'export_live'").orderBy("created_at")
    assert [(r.status, r.details) for r in log.collect()] == [("blocked", "freshness"), ("success", "")]


def test_standings_fallback_and_failure(spark, tmp_path):
    lake = str(tmp_path / "lake")
    row = {"source": "computed", "team_name": "A", "position": 1, "ingest": 1}
    computed = lambda: spark.createDataFrame([row])
    jobs.land_standings(spark, str(tmp_path / "none"), lake, at("2025-08-12 18:00:00"), computed)
    assert [r.team_name for r in spark.read.parquet(f"{lake}/bronze/live_standings").collect()] == ["A"]
    jobs.land_standings(spark, str(tmp_path / "none"), lake, at("2025-08-12 18:00:00"))
    log = spark.read.parquet(f"{lake}/bronze/pipeline_runs").orderBy("created_at").collect()
    assert [(r.status, r.rows_written) for r in log] == [("success", 1), ("failed", 0)]
    assert log[0].details == "source=computed"


def test_fallback_and_block(spark, tmp_path):
    lake = str(tmp_path / "lake")
    fallback = land(tmp_path / "other", "f", {"events": [{"idEvent": "9", "intHomeScore": "2", "strHomeTeam": "A"}]})
    jobs.land_matches(spark, str(tmp_path / "none"), lake, fallback, at("2025-08-12 18:00:00"))
    row = spark.read.parquet(f"{lake}/bronze/live_matches").first()
    assert (row.source, row.match_id, row.home_score, row.status) == ("thesportsdb", "9", 2, "SCHEDULED")
    broken = land(tmp_path / "broken", "b", {"matches": [{"id": 1}]})
    gate = jobs.land_matches(spark, broken, lake, at=at("2025-08-13 18:00:00"), block=True).first()
    assert not gate.valid and spark.read.parquet(f"{lake}/bronze/live_matches").count() == 1


def test_batch_path(spark, tmp_path):
    lake = str(tmp_path)
    day = dt.date(2024, 5, 1)
    rows = [(1, 2324, 1, day, 10, "A", 20, "B", 2, 1, "available"), (2, 2324, 2, day, 20, "B", 10, "A", 0, 0, "available"),
            (3, 9, 2, day, 20, "B", 10, "A", 5, 0, "available")]
    schema = """match_id int, season_id int, matchday int, match_date date, home_team_id int, home_team_name string,
        away_team_id int, away_team_name string, home_score int, away_score int, match_status string"""
    spark.createDataFrame(rows, schema).write.parquet(f"{lake}/bronze/matches")
    events = [("e1", 1, 7, "P", 10, "A", "Shot", "Goal"), ("e2", 1, 7, "P", 10, "A", "Pass", None)]
    kinds = "event_id string, match_id int, player_id int, player_name string, team_id int, team_name string, event_type string, outcome string"
    spark.createDataFrame(events, kinds).write.parquet(f"{lake}/bronze/events")
    for _ in range(2):
        jobs.build_batch_gold(spark, lake, 2324)
    table = gold(spark, lake, "league_table").orderBy("position").collect()
    assert [(r.position, r.team_name, r.points, r.qualification_zone) for r in table] == [
        (1, "A", 4, "champions_league"), (2, "B", 1, "champions_league"),
    ]
    assert gold(spark, lake, "recent_results").count() == 2
    assert gold(spark, lake, "top_scorers").first().goals == 1
    assert gold(spark, lake, "match_events").count() == 2


def test_declared_graph(spark, tmp_path):
    """Inputs come first whatever the order of declaration; parts are computed once, views by each reader; errors are named."""
    calls = []

    def make(name):
        def run(*dfs):
            calls.append(name)
            return dfs[0].withColumn(name, F.lit(len(dfs)))

        return run

    nodes = {
        "last": graph.Node(make("last"), ("seen", "part")),
        "seen": graph.Node(make("seen"), ("part",), graph.VIEW),
        "part": graph.Node(make("part"), ("raw",), graph.PART),
    }
    raw = spark.range(3)
    made = graph.materialised(spark, str(tmp_path), nodes, {"raw": raw})
    assert calls == ["part", "seen", "last"] and made["last"].columns == ["id", "part", "seen", "last"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["last"] and made["last"].count() == 3
    assert made["part"].inputFiles() == made["seen"].inputFiles() != []
    graph.materialised(spark, str(tmp_path), nodes, {"raw": raw.limit(1)})
    assert spark.read.parquet(str(tmp_path / "last")).count() == 1
    with pytest.raises(ValueError, match="unknown inputs: .'raw'"):
        graph.order_of(nodes, {})
    with pytest.raises(ValueError, match="declared and given"):
        graph.order_of(nodes, {"raw": raw, "seen": raw})
    with pytest.raises(CycleError):
        graph.order_of({"a": graph.Node(make("a"), ("b",)), "b": graph.Node(make("b"), ("a",))}, {})
