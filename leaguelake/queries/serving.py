"""Parameterised result sets with and without filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaguelake.plans import marts, serving
from leaguelake.plans.adapters import NEWEST, cte, load
from leaguelake.queries import league
from leaguelake.queries.registry import (
    CLEAN,
    FORM,
    LEAGUE,
    LIVE_STATE,
    LIVE_TABLE,
    RACE,
    TEAMS,
    query,
    versions,
    with_ctes,
)

LONG = ("position", "played", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points")
SHARED = """position, team_name, played, won, drawn, lost, goals_for, goals_against, goal_difference, points, win_rate,
 points_pct, goals_per_game, goals_conceded_per_game, qualification_zone"""


@query(
    with_ctes(
        *LIVE_TABLE,
        select=f"""SELECT * REPLACE ({', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in LONG)})
 FROM (SELECT {SHARED}, 'live' AS source_used FROM live_table)""",
    )
)
def served_league_table(spark, sf_dir):
    return serving.league_table(league.live_table(spark, sf_dir), league.table(spark, sf_dir))


@query(with_ctes(*LEAGUE, select=f"SELECT {SHARED}, 'batch' AS source_used FROM league"))
def served_league_table_fallback(spark, sf_dir):
    """No live rows: the batch table is served."""
    nothing = league.live_table(spark, sf_dir).filter("played < 0")
    return serving.league_table(nothing, league.table(spark, sf_dir))


def history(spark, sf_dir):
    return marts.scd2_standings(league.finished(spark, sf_dir))


@query(with_ctes(*versions(), select="SELECT * FROM versions WHERE lower(team_name) = 'club 7'"))
def standings_history_of_team(spark, sf_dir):
    return serving.standings_history(history(spark, sf_dir), team="CLUB 7")


@query(
    with_ctes(
        *versions(),
        select="SELECT * FROM versions WHERE valid_from_matchday <= 12 AND valid_to_matchday >= 12",
    )
)
def standings_history_at_matchday(spark, sf_dir):
    return serving.standings_history(history(spark, sf_dir), matchday=12)


@query(with_ctes(*versions(), select="SELECT * FROM versions WHERE is_current"))
def current_standings(spark, sf_dir):
    return serving.standings_history(history(spark, sf_dir), current_only=True)


@query(
    with_ctes(
        *RACE,
        select="""SELECT * FROM race WHERE lower(team_name) IN ('club 1', 'club 2') AND matchday BETWEEN 5 AND 20""",
    )
)
def race_of_teams(spark, sf_dir):
    return serving.race(league.race(spark, sf_dir), ["Club 1", " club 2"], 5, 20)


@query(with_ctes(*FORM, select="SELECT * FROM form WHERE team_name = 'Club 3' AND current_momentum = 'STEADY'"))
def form_of_team(spark, sf_dir):
    return serving.form(league.form(spark, sf_dir), "club 3", "steady")


@query(with_ctes(*TEAMS, select="SELECT * FROM teams WHERE tier = 'MID-TABLE'"))
def teams_of_tier(spark, sf_dir):
    return serving.teams(league.teams(spark, sf_dir), "mid-table")


RESULTS = """results AS (SELECT match_id, matchday, match_date, home_team_id, home_team_name, away_team_id,
 away_team_name, home_score, away_score, winner, match_status,
 CASE winner WHEN 'HOME_TEAM' THEN 'W' WHEN 'DRAW' THEN 'D' WHEN 'AWAY_TEAM' THEN 'L' END AS home_result,
 CASE winner WHEN 'AWAY_TEAM' THEN 'W' WHEN 'DRAW' THEN 'D' WHEN 'HOME_TEAM' THEN 'L' END AS away_result FROM clean)"""


def results(spark, sf_dir):
    return marts.recent_results(league.matches(spark, sf_dir))


@query(with_ctes(*CLEAN, RESULTS, select="SELECT * FROM results"))
def recent_results(spark, sf_dir):
    return results(spark, sf_dir)


@query(with_ctes(*CLEAN, RESULTS, select="SELECT * FROM results"))
def served_matches(spark, sf_dir):
    return serving.matches(results(spark, sf_dir))


@query(
    with_ctes(
        *CLEAN,
        RESULTS,
        select="SELECT * FROM results ORDER BY match_date DESC, matchday DESC, match_id LIMIT 5000",
    )
)
def served_results(spark, sf_dir):
    """A limit is the caller's, however high."""
    return serving.results(results(spark, sf_dir), limit=5_000)


@query(with_ctes(*CLEAN, RESULTS, select="SELECT * FROM results WHERE matchday = 9"))
def results_of_round(spark, sf_dir):
    return serving.results_by_round(results(spark, sf_dir), 9)


@query(
    with_ctes(
        cte("scorers"),
        select="""SELECT player_id, goals, row_number() OVER (ORDER BY goals DESC, assists DESC, player_id) AS rank
 FROM (SELECT * FROM scorers WHERE player_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY player_id
 ORDER BY ingested_at DESC, ingest_seq DESC) = 1) ORDER BY goals DESC, assists DESC, player_id LIMIT 200""",
    )
)
def served_scorers(spark, sf_dir):
    """A limit is the caller's."""
    ranked = marts.ranked_scorers(load(spark, sf_dir, "scorers"), order_by=NEWEST)
    return serving.scorers(ranked, limit=200).select("player_id", "goals", "rank")


@query(
    with_ctes(
        cte("scorers"),
        select="""SELECT player_id, goals, row_number() OVER (ORDER BY goals DESC, assists DESC, player_id) AS rank
 FROM (SELECT * FROM scorers WHERE player_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY player_id
 ORDER BY ingested_at DESC, ingest_seq DESC) = 1)""",
    )
)
def served_all_scorers(spark, sf_dir):
    ranked = marts.ranked_scorers(load(spark, sf_dir, "scorers"), order_by=NEWEST)
    return serving.scorers(ranked).select("player_id", "goals", "rank")


@query(
    with_ctes(
        *LIVE_STATE,
        select="""SELECT match_id, utc_date, status, home_team, away_team FROM live_state
 WHERE utc_date >= TIMESTAMP '1998-02-28' AND utc_date <= TIMESTAMP '1998-03-04'""",
    )
)
def live_window(spark, sf_dir):
    state = marts.live_state(load(spark, sf_dir, "live_matches"), order_by=NEWEST)
    window = serving.live_window(state, F.lit("1998-03-01").cast("date"))
    return window.select("match_id", "utc_date", "status", "home_team", "away_team")
