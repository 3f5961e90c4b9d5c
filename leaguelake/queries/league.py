"""League tables, form, races and team dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.operators import results
from leaguelake.operators.joins import with_side_counts
from leaguelake.operators.ordered import OrderedRows, global_row_number
from leaguelake.plans import jobs, marts
from leaguelake.plans.adapters import NEWEST, NEWEST_READING, cte, load
from leaguelake.session import new_folder, stored
from leaguelake.queries.registry import (
    FORM,
    LEAGUE,
    LIVE_SIDES,
    LIVE_STATE,
    LIVE_TABLE,
    RACE,
    SIDES,
    STANDINGS,
    TEAMS,
    WEATHER,
    query,
    versions,
    with_ctes,
)

CLUBS = [f"Club {i}" for i in range(20)]


def matches(spark, sf_dir):
    return marts.clean_matches(load(spark, sf_dir, "matches"))


def sides(spark, sf_dir, *keep):
    return marts.match_sides(matches(spark, sf_dir), keep or ("match_id", "matchday", "match_date", "season_id"))


def table(spark, sf_dir):
    return marts.league_table(matches(spark, sf_dir))


def finished(spark, sf_dir):
    """Deduplicated results, stored once: races, form and position history all start from them."""
    return stored(marts.finished_results(load(spark, sf_dir, "live_matches"), order_by=NEWEST), "finished")


def live_table(spark, sf_dir):
    return marts.live_league_table(load(spark, sf_dir, "live_standings"), order_by=NEWEST)


def form(spark, sf_dir):
    return marts.form(finished(spark, sf_dir))


def race(spark, sf_dir):
    return marts.points_race(finished(spark, sf_dir))


def teams(spark, sf_dir):
    return marts.dim_teams(live_table(spark, sf_dir), form(spark, sf_dir))


@query(with_ctes(*SIDES, select="SELECT match_id, matchday, side, team_id, team_name, gf, ga, pts, result FROM sides"))
def unpivot_sides(spark, sf_dir):
    return sides(spark, sf_dir).drop("match_date", "season_id")


@query(with_ctes(*STANDINGS, select="SELECT * FROM standings"))
def standings(spark, sf_dir):
    return results.standings(sides(spark, sf_dir, "match_id"))


@query(with_ctes(*LEAGUE, select="SELECT * FROM league"))
def league_table(spark, sf_dir):
    return table(spark, sf_dir)


@query(
    with_ctes(
        cte("matches"),
        select="""SELECT match_id, match_date, row_number() OVER (ORDER BY match_date DESC NULLS LAST, match_id)
 AS position FROM matches""",
    )
)
def global_ranking(spark, sf_dir):
    df = load(spark, sf_dir, "matches").select("match_id", "match_date")
    return global_row_number(df, ["-match_date", "match_id"])


@query(with_ctes(*LIVE_STATE, select="SELECT * EXCLUDE (matchday_approx), matchday_approx AS matchday FROM live_state"))
def live_matches(spark, sf_dir):
    state = marts.live_state(load(spark, sf_dir, "live_matches"), order_by=NEWEST)
    return state.withColumnRenamed("matchday_approx", "matchday")


@query(with_ctes(*LIVE_TABLE, select="SELECT * FROM live_table"))
def live_league_table(spark, sf_dir):
    return live_table(spark, sf_dir)


@query(with_ctes(*RACE, select="SELECT * FROM race"))
def points_race(spark, sf_dir):
    return race(spark, sf_dir)


@query(with_ctes(*FORM, select="SELECT * FROM form"))
def rolling_form(spark, sf_dir):
    return form(spark, sf_dir)


@query(with_ctes(*FORM, select="SELECT * FROM form"))
def rolling_form_in_ranges(spark, sf_dir):
    """The same with so many ranges that teams are cut, as a very large team would be."""
    return marts.form(finished(spark, sf_dir), ranges=100)


@query(
    with_ctes(
        *LIVE_SIDES,
        select="""SELECT team_name, match_id, CAST(sum(pts) OVER w AS BIGINT) AS pts_so_far,
 count(*) OVER w AS played_so_far, max(gf) OVER w AS most_goals FROM live_sides
 WINDOW w AS (PARTITION BY team_name ORDER BY matchday, match_id ROWS UNBOUNDED PRECEDING)""",
    )
)
def running_totals(spark, sf_dir):
    rows = marts.live_sides(finished(spark, sf_dir), "match_id", "matchday")
    return (
        OrderedRows(rows, ["matchday", "match_id"], ["team_name"])
        .running(pts_so_far=("sum", "pts"), played_so_far=("count", "pts"), most_goals=("max", "gf"))
        .result()
        .select("team_name", "match_id", "pts_so_far", "played_so_far", "most_goals")
    )


def recent_sql(per_side: bool) -> str:
    part = "team_id, team_name, side" if per_side else "team_id, team_name"
    return with_ctes(
        *SIDES,
        select=f"""SELECT team_id, team_name, string_agg(result, ',' ORDER BY rn DESC, side, result) AS form_string,
 count(*) AS recent_matches FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY match_date DESC NULLS LAST,
 match_id DESC) AS rn FROM sides) WHERE rn <= 5 GROUP BY team_id, team_name""",
    )


@query(recent_sql(True))
def recent_form_per_side(spark, sf_dir):
    return results.recent_form(sides(spark, sf_dir, "match_id", "match_date"))


@query(recent_sql(False))
def recent_form(spark, sf_dir):
    return results.recent_form(sides(spark, sf_dir, "match_id", "match_date"), per_side=False)


SIDE_COUNTS = """(SELECT team_id, count(*) FILTER (WHERE result = 'W') AS total_wins, count(*) AS total_matches
 FROM sides GROUP BY team_id)"""


@query(
    with_ctes(
        *LEAGUE,
        select=f"SELECT l.*, c.total_wins, c.total_matches FROM league l JOIN {SIDE_COUNTS} c USING (team_id)",
    )
)
def team_stats(spark, sf_dir):
    return marts.team_stats(matches(spark, sf_dir))


@query(
    with_ctes(
        *SIDES,
        select=f"""SELECT n_nationkey, n_name, coalesce(total_wins, 0) AS total_wins,
 coalesce(total_matches, 0) AS total_matches FROM nation LEFT JOIN {SIDE_COUNTS} ON team_id = n_nationkey""",
    )
)
def side_counts_left_join(spark, sf_dir):
    """Entities without any match get zero counts."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    entities = nation.select(F.col("n_nationkey").alias("team_id"), "n_nationkey", "n_name")
    return with_side_counts(entities, sides(spark, sf_dir, "match_id")).drop("team_id")


@query(with_ctes(*TEAMS, select="SELECT * FROM teams"))
def dim_teams(spark, sf_dir):
    return teams(spark, sf_dir)


@query(
    with_ctes(
        *FORM,
        select="""SELECT team_name, count(*) AS total_matches, count(*) FILTER (WHERE result = 'W') AS total_wins,
 count(*) FILTER (WHERE result = 'L') AS total_losses, CAST(sum(gf) AS BIGINT) AS total_goals_scored,
 CAST(sum(ga) AS BIGINT) AS total_goals_conceded, max(last_5_form) AS current_form FROM form
 WHERE recency_rank <= (SELECT max(matchday) FROM form) GROUP BY team_name""",
    )
)
def season_stats(spark, sf_dir):
    """The reference's cut: as many newest results per team as there are matchdays."""
    return marts.season_stats(form(spark, sf_dir), form_pick="max", within_matchdays=True)


@query(
    with_ctes(
        *FORM,
        select="""SELECT team_name, count(*) AS total_matches, count(*) FILTER (WHERE result = 'W') AS total_wins,
 count(*) FILTER (WHERE result = 'L') AS total_losses, CAST(sum(gf) AS BIGINT) AS total_goals_scored,
 CAST(sum(ga) AS BIGINT) AS total_goals_conceded, arg_min(last_5_form, recency_rank) AS current_form
 FROM form GROUP BY team_name""",
    )
)
def season_totals(spark, sf_dir):
    """All results."""
    return marts.season_stats(form(spark, sf_dir))


@query(
    with_ctes(
        cte("live_matches"),
        select="""SELECT matchday, min(utc_date) AS first_kickoff, max(utc_date) AS last_kickoff,
 count(*) AS total_matches, CAST(sum(CASE WHEN status = 'FINISHED' THEN 1 ELSE 0 END) AS BIGINT) AS completed,
 CAST(sum(CASE WHEN status IN ('TIMED', 'SCHEDULED') THEN 1 ELSE 0 END) AS BIGINT) AS scheduled,
 CAST(sum(CASE WHEN status IN ('IN_PLAY', 'LIVE', 'PAUSED', 'HALFTIME') THEN 1 ELSE 0 END) AS BIGINT) AS live_now,
 CAST(min(utc_date) AS DATE) AS matchday_start_date, CAST(max(utc_date) AS DATE) AS matchday_end_date,
 CASE WHEN sum(CASE WHEN status IN ('IN_PLAY', 'LIVE', 'PAUSED', 'HALFTIME') THEN 1 ELSE 0 END) > 0 THEN 'LIVE'
 WHEN sum(CASE WHEN status = 'FINISHED' THEN 1 ELSE 0 END) = count(*) THEN 'COMPLETED'
 WHEN sum(CASE WHEN status = 'FINISHED' THEN 1 ELSE 0 END) > 0 THEN 'IN_PROGRESS' ELSE 'UPCOMING' END
 AS matchday_status, coalesce(DATE '1998-03-01' BETWEEN CAST(min(utc_date) AS DATE) - 1
 AND CAST(max(utc_date) AS DATE) + 1, FALSE) AS is_active_window
 FROM (SELECT *, CAST(json_extract_string(raw_json, '$.matchday') AS INT) AS matchday FROM live_matches
 WHERE source = 'football-data.org'
 QUALIFY row_number() OVER (PARTITION BY match_id ORDER BY ingested_at DESC, ingest_seq DESC) = 1) GROUP BY matchday""",
    )
)
def dim_matchdays(spark, sf_dir):
    as_of = F.lit("1998-03-01").cast("date")
    return marts.dim_matchdays(load(spark, sf_dir, "live_matches"), as_of, order_by=NEWEST)


@query(with_ctes(*WEATHER, select="SELECT * FROM stadiums"))
def stadium_weather(spark, sf_dir):
    return marts.stadium_weather(load(spark, sf_dir, "weather"), teams(spark, sf_dir), NEWEST_READING)


@query(
    with_ctes(
        *WEATHER,
        select="""SELECT count(*) FILTER (WHERE pitch_condition IN ('Excellent', 'Good')) AS good,
 count(*) FILTER (WHERE pitch_condition LIKE '%Moderate%') AS moderate,
 count(*) FILTER (WHERE pitch_condition LIKE '%Poor%') AS poor,
 round(sum(coalesce(temperature_c, 0)) / count(*) * 9 / 5 + 32, 1) AS avg_fahrenheit FROM stadiums""",
    )
)
def weather_summary(spark, sf_dir):
    weather = marts.stadium_weather(load(spark, sf_dir, "weather"), teams(spark, sf_dir), NEWEST_READING)
    return marts.weather_summary(weather)


@query(
    with_ctes(
        *LEAGUE,
        select="""SELECT CAST(sum(goals_for) AS BIGINT) AS total_goals, CAST(sum(played) AS DOUBLE) / 2 AS total_matches,
 round(CAST(sum(goals_for) AS DOUBLE) / (CAST(sum(played) AS DOUBLE) / 2), 2) AS goals_per_match,
 arg_min(team_name, position) AS leader, first(team_name ORDER BY goals_for DESC, position) AS best_attack,
 first(team_name ORDER BY goals_against, position) AS best_defence,
 first(team_name ORDER BY won DESC, position) AS most_wins FROM league""",
    )
)
def league_totals(spark, sf_dir):
    return results.league_totals(table(spark, sf_dir))


PERCENT = ", ".join(
    f"round(CAST({m} AS DOUBLE) / (SELECT greatest(max({m}), 1) FROM league) * 100, 0) AS {m}_score"
    for m in ("goals_for", "won", "points", "win_rate", "goals_per_game")
)


@query(
    with_ctes(
        *LEAGUE,
        select=f"""SELECT team_name, {PERCENT},
 round((100 - goals_conceded_per_game * 10) / 100 * 100, 0) AS defence_score FROM league""",
    )
)
def team_profiles(spark, sf_dir):
    return results.profiles(table(spark, sf_dir))


PIVOT = ", ".join(f"max(CASE WHEN team_name = '{c}' THEN cumulative_points END) AS \"{c}\"" for c in CLUBS)


@query(with_ctes(*RACE, select=f"SELECT matchday, {PIVOT} FROM race GROUP BY matchday"))
def pivot_race(spark, sf_dir):
    return results.pivot_race(race(spark, sf_dir), CLUBS)


@query(
    with_ctes(
        *RACE,
        select="""SELECT matchday, count(*) AS n_teams, string_agg(team_name, ',' ORDER BY team_name) AS teams,
 string_agg(CAST(cumulative_points AS VARCHAR), ',' ORDER BY team_name) AS points FROM race GROUP BY matchday""",
    )
)
def pivot_race_all(spark, sf_dir):
    """All teams that are found, in the order of their names; lists as text."""
    wide = results.race_by_period(race(spark, sf_dir))
    return wide.select(
        "matchday", "n_teams", F.array_join("teams", ",").alias("teams"), F.array_join(F.col("points").cast("array<string>"), ",").alias("points")
    )


@query(
    with_ctes(
        *RACE,
        select="""SELECT * FROM race WHERE matchday = (SELECT max(matchday) FROM race)
 ORDER BY cumulative_points DESC, team_name LIMIT 6""",
    )
)
def race_leaders(spark, sf_dir):
    return results.leaders(race(spark, sf_dir))


@query(
    with_ctes(
        cte("match_events"),
        select="""SELECT event_id, ts, local_date, row_number() OVER (PARTITION BY local_date ORDER BY ts, event_id)
 AS place FROM (SELECT event_id, ts, CAST(ts - INTERVAL 5 HOUR AS DATE) AS local_date FROM match_events)""",
    )
)
def by_local_date(spark, sf_dir):
    """New York dates; all times are in winter, five hours behind UTC."""
    rows = load(spark, sf_dir, "match_events").select("event_id", "ts")
    return results.by_local_date(rows, "ts", tie_break=["event_id"])


ROUNDS = with_ctes(
    cte("matches"),
    """days AS (SELECT season_id, match_date, count(*) AS n, row_number() OVER (PARTITION BY season_id
 ORDER BY match_date) AS i FROM matches WHERE match_date IS NOT NULL GROUP BY season_id, match_date)""",
    """folded AS (SELECT season_id, match_date, i, 1 AS round, n AS played FROM days WHERE i = 1 UNION ALL
 SELECT d.season_id, d.match_date, d.i,
 CASE WHEN d.match_date - f.match_date > 3 AND f.played >= 8 THEN f.round + 1 ELSE f.round END,
 CASE WHEN d.match_date - f.match_date > 3 AND f.played >= 8 THEN d.n ELSE f.played + d.n END
 FROM folded f JOIN days d ON d.season_id = f.season_id AND d.i = f.i + 1)""",
    select="""SELECT m.match_id, m.season_id, m.match_date, coalesce(f.round, 1) AS matchday FROM matches m
 LEFT JOIN folded f ON f.season_id = m.season_id AND f.match_date = m.match_date""",
    recursive=True,
)


@query(ROUNDS)
def infer_rounds(spark, sf_dir):
    rows = load(spark, sf_dir, "matches").select("match_id", "season_id", "match_date")
    return results.infer_rounds(rows)


@query(
    with_ctes(
        cte("scorers"),
        select="""SELECT row_number() OVER (ORDER BY goals DESC, assists DESC, player_id) AS rank, player_id, player_name,
 team_name, goals, assists, goal_contributions, matches_played, goals_per_game,
 CASE WHEN matches_played = 0 THEN NULL ELSE round(CAST(assists AS DOUBLE) / matches_played, 2) END AS assists_per_game
 FROM (SELECT * FROM scorers WHERE player_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY player_id
 ORDER BY ingested_at DESC, ingest_seq DESC) = 1) ORDER BY goals DESC, assists DESC, player_id LIMIT 30""",
    )
)
def top_scorers(spark, sf_dir):
    return marts.top_scorers(load(spark, sf_dir, "scorers"), order_by=NEWEST)


GOLD = """SELECT * FROM (SELECT 'points_race' AS name, count(*) AS n, CAST(sum(cumulative_points) AS BIGINT) AS total FROM race
 UNION ALL SELECT 'rolling_form', count(*), CAST(sum(recency_rank) AS BIGINT) FROM form
 UNION ALL SELECT 'scd2_standings', count(*), CAST(sum(matchdays_held) AS BIGINT) FROM versions
 UNION ALL SELECT 'race_leaders', least(6, count(*)), CAST(max(cumulative_points) AS BIGINT) FROM race
 WHERE matchday = (SELECT max(matchday) FROM race))"""


@query(with_ctes(*RACE, FORM[-1], *versions()[len(LIVE_SIDES) :], select=GOLD))
def gold_of_a_built_lake(spark, sf_dir):
    """A lake is landed from the given tables and its gold tables are made as declared; tables are read back, a view is computed."""
    lake = new_folder(spark, "lake")
    for name in ("live_matches", "live_standings"):
        load(spark, sf_dir, name).write.parquet(f"{lake}/bronze/{name}")
    at = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    made = jobs.build_live_gold(spark, lake, at, NEWEST)
    measures = {"points_race": "cumulative_points", "rolling_form": "recency_rank", "scd2_standings": "matchdays_held"}
    rows = [
        made[t].agg(F.lit(t).alias("name"), F.count(F.lit(1)).alias("n"), F.sum(c).cast("long").alias("total")) for t, c in measures.items()
    ]
    last = made["race_leaders"].agg(F.lit("race_leaders").alias("name"), F.count(F.lit(1)).alias("n"), F.max("cumulative_points").alias("total"))
    return reduce(DataFrame.unionByName, [*rows, last])
