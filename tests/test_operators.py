"""Hand-made cases: contracts, history, landing, exports and quirks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.operators import events, history, joins, quality, results
from leaguelake.plans import marts, serving
from leaguelake.session import new_folder
from leaguelake.sources import exports, feeds, landing

MATCH = {
    "id": 1,
    "utcDate": "2026-02-23T15:00:00Z",
    "status": "FINISHED",
    "matchday": 27,
    "homeTeam": {"id": 57, "name": "Arsenal FC"},
    "awayTeam": {"id": 65, "name": "Manchester City FC"},
}
STANDING = {
    "position": 1,
    "team": {"id": 57, "name": "Arsenal FC"},
    "playedGames": 27,
    "won": 20,
    "draw": 5,
    "lost": 2,
    "points": 65,
    "goalsFor": 60,
    "goalsAgainst": 20,
    "goalDifference": 40,
}


def found(spark, record, contract=values.MATCH_CONTRACT):
    text = record if isinstance(record, str) else json.dumps(record)
    rows = quality.violations(spark.createDataFrame([(1, text)], "n int, raw_json string"), contract, ["n"]).collect()
    return [(r.field, r.rule, r.severity) for r in rows]


def without(record, key):
    return {k: v for k, v in record.items() if k != key}


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        (MATCH, []),
        (without(MATCH, "status"), [("status", "required", "ERROR")]),
        ({**MATCH, "status": "INVALID_STATUS"}, [("status", "enum", "WARN")]),
        ({**MATCH, "status": None}, [("status", "enum", "WARN")]),
        ({**MATCH, "id": None}, []),
        ({**MATCH, "id": "x"}, [("id", "type", "ERROR")]),
        ({**MATCH, "id": 1.0}, [("id", "type", "ERROR")]),
        ({**MATCH, "id": 2**70}, []),
        ({**MATCH, "id": True}, []),
        ({**MATCH, "matchday": 39}, [("matchday", "range", "ERROR")]),
        ({**MATCH, "matchday": "39"}, [("matchday", "type", "ERROR")]),
        ({**MATCH, "homeTeam": "none"}, []),
        ({**MATCH, "homeTeam": {"id": 1}}, [("homeTeam.name", "nested_required", "ERROR")]),
        ("[1, 2]", [("raw_json", "json", "ERROR")]),
        ("{broken", [("raw_json", "json", "ERROR")]),
    ],
)
def test_match_contract(spark, record, expected):
    assert found(spark, record) == expected


@pytest.mark.parametrize(
    ("record", "expected"),
    [
        (STANDING, []),
        (without(STANDING, "team"), [("team", "required", "ERROR")]),
        ({**STANDING, "points": -5}, [("points", "range", "ERROR")]),
    ],
)
def test_standings_contract(spark, record, expected):
    assert found(spark, record, values.STANDINGS_CONTRACT) == expected


@pytest.mark.parametrize(("bad", "total", "valid"), [(1, 20, True), (3, 10, False), (0, 0, True)])
def test_contract_gate(spark, bad, total, valid):
    rows = [(json.dumps(without(MATCH, "status") if i < bad else MATCH),) for i in range(total)]
    gate = quality.contract_gate(spark.createDataFrame(rows, "raw_json string"), values.MATCH_CONTRACT).first()
    assert (gate.valid, gate.records_checked, gate.records_passed) == (valid, total, total - bad)
    good, broken = quality.quarantine(spark.createDataFrame(rows, "raw_json string"), values.MATCH_CONTRACT)
    assert (good.count(), broken.count()) == (total - bad, bad)


def matches(spark, rows):
    schema = "match_id int, matchday int, match_date date, home_team string, away_team string, home_score int, away_score int"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def season(spark):
    """Four teams, double round robin over six matchdays."""
    rounds = [("AB", "CD"), ("AC", "BD"), ("AD", "BC"), ("BA", "DC"), ("CA", "DB"), ("DA", "CB")]
    rows = []
    for md, pairs in enumerate(rounds, 1):
        for i, (h, a) in enumerate(pairs):
            day = dt.date(2024, 8, 1) + dt.timedelta(days=7 * md)
            rows.append((md * 10 + i, md, day, h, a, (md * 3 + i * 5) % 4, (md + i * 2) % 3))
    return matches(spark, rows)


def test_versions_are_contiguous(season):
    versions = history.scd2(marts.live_sides(season, "matchday", "match_date")).collect()
    for team in "ABCD":
        own = sorted((v for v in versions if v.team_name == team), key=lambda v: v.valid_from_matchday)
        assert own[0].movement == "NEW" and own[0].valid_from_matchday == 1
        assert [v.is_current for v in own] == [False] * (len(own) - 1) + [True]
        assert own[-1].valid_to_matchday == 6
        for one, two in zip(own, own[1:]):
            assert two.valid_from_matchday == one.valid_to_matchday + 1
            assert two.prev_position == one.position != two.position
            assert two.movement == ("UP" if two.position < one.position else "DOWN")


def test_version_statistics(spark):
    """A falls from +3 to +1 goals while staying first: the last value differs from the highest."""
    rows = [
        (1, 1, dt.date(2024, 8, 1), "A", "B", 3, 0),
        (2, 2, dt.date(2024, 8, 8), "B", "A", 2, 0),
        (3, 2, dt.date(2024, 8, 8), "A", "C", 1, 0),
    ]
    sides = marts.live_sides(matches(spark, rows), "matchday", "match_date")
    last, highest = (
        {v.team_name: v.goal_difference for v in history.scd2(sides, stats=s).collect() if v.team_name == "A"}
        for s in ("last", "max")
    )
    assert last == {"A": 2} and highest == {"A": 3}


def test_points_add_up(season):
    sides = marts.live_sides(season, "matchday")
    assert sides.count() == 2 * season.count()
    race = marts.points_race(season).collect()
    final = {r.team_name: r.cumulative_points for r in race if r.matchday == 6}
    assert final == {r.team_name: r.points for r in results.standings(sides, ["team_name"]).collect()}
    assert sum(r.matchday_points for r in race) == sum(final.values())


def test_scd1(spark):
    rows = [("m1", 1, "TIMED"), ("m1", 3, "FINISHED"), ("m1", 2, "LIVE"), ("m2", 5, "TIMED")]
    df = spark.createDataFrame(rows, "match_id string, ingested_at int, status string")
    out = {r.match_id: r for r in history.scd1(df, ["match_id"], ["-ingested_at"]).collect()}
    m1, m2 = out["m1"], out["m2"]
    assert (m1.status, m1.first_seen_at, m1.last_updated_at, m1.update_count, m1.is_correction) == (
        "FINISHED", 1, 3, 3, True,
    )
    assert (m2.update_count, m2.is_correction) == (1, False)


def test_current_form_options(spark):
    rows = [("A", 1, 2, "W", 1, 0, "WWW"), ("A", 2, 1, "L", 0, 1, "DLL")]
    schema = "team_name string, matchday int, recency_rank long, result string, gf int, ga int, last_5_form string"
    form = spark.createDataFrame(rows, schema)
    assert marts.season_stats(form).first().current_form == "DLL"
    assert marts.season_stats(form, "max").first().current_form == "WWW"


def test_season_stats_takes_all_results(spark):
    """More results than matchdays: only the named option leaves any out."""
    rows = [("A", 1, rank, "W" if rank > 2 else "L", rank, 1, f"F{rank}") for rank in range(1, 6)]
    schema = "team_name string, matchday int, recency_rank long, result string, gf int, ga int, last_5_form string"
    form = spark.createDataFrame(rows, schema)
    assert tuple(marts.season_stats(form).first()) == ("A", 5, 3, 2, 15, 5, "F1")
    assert tuple(marts.season_stats(form, within_matchdays=True).first()) == ("A", 1, 0, 1, 1, 1, "F1")


def test_all_scorers_are_served(spark):
    rows = [(i, 1000 - i // 2, i % 3, 0) for i in range(500)] + [(7, 5000, 0, 1), (None, 9, 9, 0)]
    scorers = spark.createDataFrame(rows, "player_id long, goals int, assists int, seq int")
    want = sorted(((-g, -a, i) for i, g, a, s in rows if i is not None and (i != 7 or s)))
    for ranges in (8, 1):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        ranked = marts.ranked_scorers(scorers, ["-seq"])
        got = [(r["rank"], r.player_id) for r in serving.scorers(ranked).collect()]
        assert got == [(n, i) for n, (_, _, i) in enumerate(want, 1)]
        assert [r.player_id for r in serving.scorers(ranked, 300).collect()] == [i for *_, i in want[:300]]
    spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_race_has_teams_outside_the_list(spark, monkeypatch):
    from leaguelake.queries import QUERIES, league

    race = spark.createDataFrame([("Club 1", 1, 3), ("Newcomer", 1, 1)], "team_name string, matchday int, cumulative_points long")
    monkeypatch.setattr(league, "race", lambda spark, sf_dir: race)
    row = QUERIES["pivot_race_all"](spark, "").first()
    assert row.asDict() == {"matchday": 1, "Club 1": 3, "Newcomer": 1}


def test_replay_is_written_and_read_back(spark):
    from leaguelake.queries import events as given

    folder, path = "/root/testdata/sf0.001", new_folder(spark, "replay")
    rows, matches = given.events(spark, folder), given.matches(spark, folder)
    exports.export_replay(rows, matches, path, n=4)
    index, wanted = exports.replay_bundle(rows, matches, 4)
    names = ["match_id", "event_count", "home_score", "away_score"]
    got = spark.read.json(f"{path}/_index.json").select(*names).collect()
    assert len(got) == 4 and sorted(map(tuple, got)) == sorted(map(tuple, index.select(*names).collect()))
    names = ["match_id", "index", "event_id", "event_type"]
    got = sorted(map(tuple, spark.read.json(f"{path}/events").select(*names).collect()))
    assert got == sorted(map(tuple, wanted.select(*names).collect()))
    assert len(got) == index.agg(F.sum("event_count")).first()[0]


def test_rounds(spark):
    """A gap alone does not start a round: the round needs eight matches first."""
    days = [(1, 4), (6, 4), (7, 1), (20, 2), (40, 9), (41, 1)]
    rows = [(i * 100 + n, 1, dt.date(2024, 1, 1) + dt.timedelta(days=d)) for i, (d, k) in enumerate(days) for n in range(k)]
    rows.append((999, 1, None))
    df = spark.createDataFrame(rows, "match_id int, season_id int, match_date date")
    out = {r.match_id: r.matchday for r in results.infer_rounds(df).collect()}
    assert [out[i * 100] for i in range(6)] == [1, 1, 1, 2, 2, 2]
    assert out[999] == 1


def test_hot_key_join(spark):
    """Most events belong to one match; every event is kept once, with its own match."""
    fact = spark.range(5000).select(
        F.col("id").alias("event_id"), F.when(F.col("id") % 3 < 2, 7).otherwise(F.col("id")).alias("match_id")
    )
    dim = spark.range(5000).select(F.col("id").alias("match_id"), (F.col("id") * 2).alias("twice"))
    assert joins.hot_keys(fact, "match_id").first().hot == [7]
    out = joins.enrich(fact, dim, "match_id", ["event_id"])
    assert out.count() == 5000 == out.select("event_id").distinct().count()
    assert out.filter("twice != match_id * 2").isEmpty()
    assert joins.enrich(fact.limit(0), dim, "match_id", ["event_id"]).isEmpty()


def test_landing_is_idempotent(spark):
    path = new_folder(spark, "test-insert")
    batch = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "id int, v string")
    for _ in range(2):
        landing.insert_new_keys(batch, path, ["id"], ["v"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "c")]


def test_replace_keys_leaves_other_partitions(spark):
    path = new_folder(spark, "test-replace")
    landing.replace_keys(spark.createDataFrame([(1, "x", 1), (2, "x", 1), (3, "y", 1)], "k int, p string, v int"), path, ["k"], ["p"])
    landing.replace_keys(spark.createDataFrame([(1, "x", 2), (1, "x", 3)], "k int, p string, v int"), path, ["k"], ["p"])
    out = spark.read.parquet(path).select("k", "p", "v").collect()
    assert sorted(map(tuple, out)) == [(1, "x", 2), (1, "x", 3), (2, "x", 1), (3, "y", 1)]


@pytest.mark.parametrize("ranges", [1, 12])
def test_as_of_versions_with_gaps_and_wide_periods(spark, monkeypatch, ranges):
    make = history.OrderedRows
    monkeypatch.setattr(history, "OrderedRows", lambda *a: make(*a, ranges=ranges))
    versions = spark.createDataFrame(
        [("a", 1, 3, 10), ("a", 6, 3_000_000, 11), ("a", 9_000_000, 8_000_000, 12), ("b", 2, 2, 20), (None, 1, 9, 30)],
        "team_name string, valid_from_matchday int, valid_to_matchday int, position int",
    )
    asked = [("a", 0), ("a", 1), ("a", 3), ("a", 3), ("a", 4), ("a", 6), ("a", 2_999_999), ("a", 3_000_001), ("a", 9_000_001)]
    asked += [("b", 1), ("b", 2), ("b", 3), ("c", 1), (None, 2), ("a", None)]
    points = spark.createDataFrame([(i, *r) for i, r in enumerate(asked)], "n int, team_name string, matchday long")
    out = sorted((r.n, r.valid_from_matchday, r.position) for r in history.as_of_versions(points, versions).collect())
    hits = {1: (1, 10), 2: (1, 10), 3: (1, 10), 5: (6, 11), 6: (6, 11), 10: (2, 20)}
    assert out == [(i, *hits.get(i, (None, None))) for i in range(len(asked))]


def test_first_available(spark):
    rows = spark.createDataFrame([(1,)], "n int")

    def broken():
        raise OSError("no such feed")

    used = landing.first_available(("a", broken), ("b", rows.limit(0)), ("c", rows), ("d", rows)).collect()
    assert [(r.n, r.source_used) for r in used] == [(1, "c")]


def test_sanitize(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (float("inf"), "y"), (42.5, "z")], "v double, t string")
    assert [tuple(r) for r in exports.sanitize_nonfinite(df).collect()] == [(None, "x"), (None, "y"), (42.5, "z")]


def test_document_parts(spark):
    table = spark.createDataFrame([(1, "A"), (2, "B")], "team_id int, team_name string")
    rows = spark.createDataFrame([(1, i) for i in range(25)], "team_id int, match_id int")
    out = exports.entity_documents(table, {"matches": (rows, ["-match_id"])}, per_part=10).collect()
    parts = {(d.team_id, d.part): d for d in out}
    assert sorted(parts) == [(1, 0), (1, 1), (1, 2), (2, 0)]
    assert [m.match_id for p in range(3) for m in parts[1, p].matches] == list(range(24, -1, -1))
    assert parts[1, 0].standings.team_name == "A" and parts[1, 1].standings is None and parts[2, 0].matches == []


def test_short_years_and_feed_defaults(spark):
    df = spark.createDataFrame([("17/08/2023",), ("17/08/23",), ("17/08/95",), ("x",), (None,)], "d string")
    assert [r[0] for r in df.select(feeds.first_date("d")).collect()] == [
        dt.date(2023, 8, 17), dt.date(2023, 8, 17), dt.date(1995, 8, 17), None, None,
    ]
    payload = json.dumps({"matches": [{**MATCH, "extra": {"a": [1]}, "score": {"winner": None, "fullTime": {"home": 2, "away": 1}}}]})
    row = feeds.normalize_match_feed(spark.createDataFrame([(payload,)], "payload string")).first()
    assert (row.match_id, row.competition, row.season) == ("1", "Premier League", "current")
    assert (row.home_score, row.winner, row.utc_date) == (2, None, dt.datetime(2026, 2, 23, 15))
    assert json.loads(row.raw_json)["extra"] == {"a": [1]}


def test_week_and_minutes(spark):
    days = [dt.datetime(2019, 1, 1) + dt.timedelta(days=i) for i in range(0, 2200, 3)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    assert [r[0] for r in df.select(C.monday_week("t")).collect()] == [int(d.strftime("%W")) for d in days]
    pair = [(dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 1, 1)), (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)),
            (dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 0))]
    out = spark.createDataFrame(pair, "a timestamp_ntz, b timestamp_ntz").select(C.minutes_since("a", "b")).collect()
    assert [r[0] for r in out] == [2, 0, 1]


def test_rounding(spark):
    df = spark.createDataFrame([(1.005,), (2.5,), (-2.5,), (0.125,), (None,)], "v double")
    assert [r[0] for r in df.select(C.round_to(F.col("v"), 2)).collect()] == [1.0, 2.5, -2.5, 0.13, None]


def test_replay_schedule(spark):
    rows = [(1, 1, 0, 5, 1), (1, 1, 2, 0, 2), (1, 2, 1, 0, 3)]
    df = spark.createDataFrame(rows, "match_id int, period int, minute int, second int, index_num int")
    out = events.replay_schedule(df.withColumn("event_id", F.col("index_num")), speed=500).orderBy("index").collect()
    assert [(r.delay_seconds, r.emit_ms, r.total) for r in out] == [(5, 50.0, 3), (115, 1200.0, 3), (0, 1200.0, 3)]


def test_served_filters(season):
    versions = history.scd2(marts.live_sides(season, "matchday", "match_date"))
    assert serving.standings_history(versions).count() == versions.count()
    assert serving.standings_history(versions, matchday=3).count() == 4
    assert {r.team_name for r in serving.standings_history(versions, team="a").collect()} == {"A"}
    assert serving.standings_history(versions, current_only=True).count() == 4
    long = versions.limit(1).withColumn("team_name", F.lit("n" * 101))
    assert serving.standings_history(long, team="n" * 100).count() == 0
    assert serving.standings_history(long, team="N" * 101).count() == 1
    assert serving.race(versions.withColumn("matchday", F.lit(46)), first=40, last=46).count() == versions.count()


def test_report_and_missing_table(spark):
    table = spark.createDataFrame([(3, 1, 0, 1, -3, 2, 1, 1)], "played int, won int, drawn int, lost int, points int, goals_for int, goals_against int, goal_difference int")
    rows = quality.report(
        quality.run_checks(table, quality.TABLE_RULES), quality.missing_table(table, "raw.none", "not found")
    )
    assert {r.name: r.passed for r in rows.collect()} == {
        "No negative points": False, "Points = W*3 + D": False, "Played = W + D + L": False, "GD = GF - GA": True,
        "raw.none exists": False,
    }
    summary = quality.report_summary(rows).first()
    assert (summary.total, summary.passed, summary.failed, summary.gate_open) == (5, 1, 4, False)


def test_enrich_empty_and_null_keys(spark):
    from leaguelake.operators import joins

    dim = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, name string")
    fact = spark.range(2000).select("id", F.when(F.col("id") % 10 == 0, F.lit(1)).alias("k"))
    assert joins.enrich(fact.limit(0), dim, "k", ["id"]).count() == 0
    assert joins.enrich(fact, dim, "k", ["id"]).count() == 200
    left = joins.enrich(fact, dim.hint("merge"), "k", ["id"], how="left")
    assert left.count() == 2000 and left.filter("name IS NOT NULL").count() == 200


def test_change_islands_on_null(spark):
    from leaguelake.operators import history

    rows = spark.createDataFrame([(1, i, v) for i, v in enumerate(["a", None, None, "a"])], "e int, at int, v string")
    assert [r.version_group for r in history.change_islands(rows, ["e"], ["at"], "v").orderBy("at").collect()] == [1, 2, 2, 3]


def test_pivot_over_all_teams(spark):
    from leaguelake.operators import results

    race = spark.createDataFrame([(1, "x", 3), (1, "y", 1), (2, "x", 4)], "matchday int, team_name string, cumulative_points int")
    assert results.pivot_race(race).columns == ["matchday", "x", "y"]


def test_replace_keys_wherever_they_are(spark):
    path = new_folder(spark, "test-moved")
    shape = "k int, p string, v int"
    landing.replace_keys(spark.createDataFrame([(1, "x", 1), (2, "y", 1), (3, "y", 1), (4, None, 1), (5, "z", 1)], shape), path, ["k"], ["p"])
    landing.replace_keys(spark.createDataFrame([(1, "y", 2), (4, "w", 2), (6, None, 2)], shape), path, ["k"], ["p"])
    out = sorted(map(str, (tuple(r) for r in spark.read.parquet(path).select("k", "p", "v").collect())))
    assert out == sorted(map(str, [(1, "y", 2), (2, "y", 1), (3, "y", 1), (4, "w", 2), (5, "z", 1), (6, None, 2)]))
    landing.replace_keys(spark.createDataFrame([], shape), path, ["k"], ["p"])
    assert spark.read.parquet(path).count() == 6


def test_failed_replacement_leaves_the_table(spark):
    path = new_folder(spark, "test-failed")
    shape = "k int, p string, v int"
    landing.replace_keys(spark.createDataFrame([(1, "x", 1), (2, "y", 1)], shape), path, ["k"], ["p"])
    broken = spark.createDataFrame([(1, "y", 0)], shape).withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        landing.replace_keys(broken, path, ["k"], ["p"])
    assert sorted(tuple(r) for r in spark.read.parquet(path).select("k", "p", "v").collect()) == [(1, "x", 1), (2, "y", 1)]


def test_inserts_read_files_that_can_hold_the_keys(spark):
    path = new_folder(spark, "test-ranges")
    for first in (0, 100, 200):
        landing.insert_new_keys(spark.range(first, first + 100).coalesce(1), path, ["id"], ["id"])
    batch = spark.range(150, 250, 10)
    assert len(landing.that_may_hold(batch, path, "id").inputFiles()) == 2
    assert landing.that_may_hold(spark.range(900, 901), path, "id") is None
    assert landing.that_may_hold(spark.range(0), path, "id") is None
    landing.insert_new_keys(spark.range(250, 350, 10), path, ["id"], ["id"])
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [*range(300), *range(300, 350, 10)]
    spark.range(1000, 1010).write.mode("append").parquet(path)  # written by others, or by a run that was lost: not noted yet
    landing.insert_new_keys(spark.range(1005, 1015), path, ["id"], ["id"])
    assert spark.read.parquet(path).filter("id >= 1000").count() == 15
    keys = "_key_ranges"
    assert sum(r.n for r in spark.read.parquet(f"{path}/{keys}").collect()) == spark.read.parquet(path).count()


def test_scd1_plan_and_null_keys(spark):
    rows = [(1, None, "a", 1), (1, None, "b", 2), (None, 2, "c", 3), (None, 2, "d", 1), (1, 2, "e", 5)]
    df = spark.createDataFrame(rows, "k int, l int, v string, ingested_at int").repartition(3)
    out = history.scd1(df, ["k", "l"], ["-ingested_at", "v"])
    got = {(r.k, r.l): (r.v, r.first_seen_at, r.last_updated_at, r.update_count, r.is_correction) for r in out.collect()}
    assert got == {(1, None): ("b", 1, 2, 2, True), (None, 2): ("c", 1, 3, 2, True), (1, 2): ("e", 5, 5, 1, False)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def test_enrich_reads_the_fact_once_where_spark_broadcasts(spark):
    fact = spark.range(1000).selectExpr("id", "id % 7 AS k")
    dim = spark.range(5).selectExpr("id AS k", "id * 2 AS w")
    plain = joins.enrich(fact, dim, "k", ["id"])
    assert plain._jdf.queryExecution().executedPlan().toString().count("Range (0, 1000") == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        salted = joins.enrich(fact, dim, "k", ["id"])
        assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
        left = joins.enrich(fact.withColumn("k", F.when(F.col("k") > 2, F.col("k"))), dim, "k", ["id"], "left")
        assert left.count() == 1000 and left.filter("w IS NOT NULL").count() == fact.filter("k IN (3, 4)").count()
        assert joins.enrich(fact.limit(0), dim, "k", ["id"], "left").count() == 0
        assert set(joins.hot_keys(fact, "k").first().hot) == set(range(7))
        assert joins.hot_keys(fact.withColumn("k", F.lit(None).cast("long")), "k").first().hot == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_season_csv_is_numbered_once(spark):
    rows = spark.createDataFrame(
        [(i, f"{1 + i // 9:02d}/08/2023", "Arsenal", "Chelsea", "1", "0") for i in range(30)],
        "Seq long, Date string, HomeTeam string, AwayTeam string, FTHG string, FTAG string",
    )
    out = feeds.normalize_season_csv(rows, ["Seq"])
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 2  # ids and rounds
    assert sorted(r.match_id for r in out.collect()) == list(range(10001, 10031))


def test_team_documents_find_results_once(spark, monkeypatch):
    from leaguelake.queries import QUERIES

    made = []
    real = marts.finished_results
    monkeypatch.setattr(marts, "finished_results", lambda *a, **k: made.append(1) or real(*a, **k))
    assert QUERIES["team_documents"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(made) == 1
