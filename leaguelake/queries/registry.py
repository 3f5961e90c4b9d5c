"""Registration of queries and shared comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from leaguelake.plans.adapters import cte

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its comparison SQL."""

    def register(f: Query) -> Query:
        key = name or f.__name__
        assert key not in QUERIES, key
        QUERIES[key] = f
        if sql:
            SQL[key] = sql
        return f

    return register


def with_ctes(*parts: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} {select}"


def clean_club(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, ' FC$', ''), '^AFC ', '')"


POINTS = "CASE WHEN gf > ga THEN 3 WHEN gf = ga THEN 1 ELSE 0 END"
RESULT = "CASE WHEN gf > ga THEN 'W' WHEN gf = ga THEN 'D' ELSE 'L' END"
WINNER = """CASE WHEN home_score > away_score THEN 'HOME_TEAM' WHEN away_score > home_score THEN 'AWAY_TEAM'
 WHEN home_score = away_score THEN 'DRAW' END"""


def zone(middle: str = "NULL") -> str:
    return f"""CASE WHEN position <= 4 THEN 'champions_league' WHEN position = 5 THEN 'europa_league'
 WHEN position = 6 THEN 'conference_league' WHEN position >= 18 THEN 'relegation' ELSE {middle} END"""


# Batch results: matches -> clean -> sides -> standings -> league.
CLEAN = [
    cte("matches"),
    f"clean AS (SELECT *, {WINNER} AS winner FROM matches WHERE match_status = 'available')",
]
SIDES = [
    *CLEAN,
    f"""sides AS (SELECT *, {POINTS} AS pts, {RESULT} AS result FROM (
 SELECT match_id, season_id, matchday, match_date, 'home' AS side, home_team_id AS team_id,
 home_team_name AS team_name, home_score AS gf, away_score AS ga FROM clean WHERE home_score IS NOT NULL
 UNION ALL SELECT match_id, season_id, matchday, match_date, 'away', away_team_id, away_team_name, away_score,
 home_score FROM clean WHERE away_score IS NOT NULL))""",
]
STANDINGS = [
    *SIDES,
    """standings AS (SELECT team_id, team_name, count(*) AS played,
 CAST(sum(CASE WHEN gf > ga THEN 1 ELSE 0 END) AS BIGINT) AS won,
 CAST(sum(CASE WHEN gf = ga THEN 1 ELSE 0 END) AS BIGINT) AS drawn,
 CAST(sum(CASE WHEN gf < ga THEN 1 ELSE 0 END) AS BIGINT) AS lost,
 CAST(sum(pts) AS BIGINT) AS points, CAST(sum(gf) AS BIGINT) AS goals_for, CAST(sum(ga) AS BIGINT) AS goals_against,
 CAST(sum(gf) - sum(ga) AS BIGINT) AS goal_difference FROM sides GROUP BY team_id, team_name)""",
]
LEAGUE = [
    *STANDINGS,
    f"""league AS (SELECT *, {zone("'midtable'")} AS qualification_zone FROM (SELECT row_number() OVER (
 ORDER BY points DESC, goal_difference DESC, goals_for DESC, team_id) AS position, *,
 round(CAST(points AS DOUBLE) / (played * 3) * 100, 1) AS points_pct,
 round(CAST(won AS DOUBLE) / played * 100, 1) AS win_rate,
 round(CAST(goals_for AS DOUBLE) / played, 2) AS goals_per_game,
 round(CAST(goals_against AS DOUBLE) / played, 2) AS goals_conceded_per_game FROM standings))""",
]

# Live feeds: live_matches -> live_state and finished -> live_sides.
NEWEST = "ingested_at DESC, ingest_seq DESC"
STATUS = """CASE WHEN status IN ('IN_PLAY', 'LIVE') THEN 'LIVE' WHEN status IN ('PAUSED', 'HALFTIME') THEN 'HALFTIME'
 WHEN status IN ('TIMED', 'SCHEDULED', 'Not Started') THEN 'SCHEDULED' ELSE status END"""


def newest(table: str, key: str, where: str = "TRUE", order: str = NEWEST) -> str:
    return f"""(SELECT * FROM {table} WHERE {where}
 QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order}) = 1)"""


PRIMARY = "source = 'football-data.org'"
LIVE_COLUMNS = f"""match_id, utc_date, {STATUS} AS status, minute, {clean_club('home_team_name')} AS home_team,
 {clean_club('away_team_name')} AS away_team, home_team_name AS home_team_raw, away_team_name AS away_team_raw,
 coalesce(home_score, 0) AS home_score, coalesce(away_score, 0) AS away_score, winner, competition, season,
 CAST(strftime(utc_date, '%W') AS INT) AS matchday_approx"""
LIVE_STATE = [
    cte("live_matches"),
    f"live_state AS (SELECT {LIVE_COLUMNS}, ingested_at FROM {newest('live_matches', 'match_id', PRIMARY)})",
]
FINISHED = [
    cte("live_matches"),
    f"""finished AS (SELECT match_id, CAST(json_extract_string(raw_json, '$.matchday') AS INT) AS matchday, home_score,
 away_score, utc_date, CAST(utc_date AS DATE) AS match_date, {clean_club('home_team_name')} AS home_team,
 {clean_club('away_team_name')} AS away_team
 FROM {newest('live_matches', 'match_id', PRIMARY + " AND status = 'FINISHED' AND home_score IS NOT NULL")})""",
]
LIVE_SIDES = [
    *FINISHED,
    f"""live_sides AS (SELECT *, {POINTS} AS pts, {RESULT} AS result FROM (
 SELECT match_id, matchday, match_date, home_team AS team_name, home_score AS gf, away_score AS ga FROM finished
 UNION ALL SELECT match_id, matchday, match_date, away_team, away_score, home_score FROM finished))""",
]
LIVE_TABLE = [
    cte("live_standings"),
    f"""live_table AS (SELECT position, {clean_club('team_name')} AS team_name, team_name AS team_name_raw, played, won,
 draw AS drawn, lost, goals_for, goals_against, coalesce(goal_difference, goals_for - goals_against) AS goal_difference,
 points, form, season, ingested_at,
 CASE WHEN played > 0 THEN round(won * CAST(100 AS DOUBLE) / played, 1) ELSE 0 END AS win_rate,
 CASE WHEN played > 0 THEN round(points * CAST(100 AS DOUBLE) / (played * 3), 1) ELSE 0 END AS points_pct,
 CASE WHEN played > 0 THEN round(goals_for * CAST(1 AS DOUBLE) / played, 2) ELSE 0 END AS goals_per_game,
 CASE WHEN played > 0 THEN round(goals_against * CAST(1 AS DOUBLE) / played, 2) ELSE 0 END AS goals_conceded_per_game,
 {zone()} AS qualification_zone FROM {newest('live_standings', 'team_name', PRIMARY)})""",
]
RACE = [
    *LIVE_SIDES,
    """race AS (SELECT team_name, matchday, matchday_points, CAST(sum(matchday_points) OVER (PARTITION BY team_name
 ORDER BY matchday) AS BIGINT) AS cumulative_points FROM (SELECT team_name, matchday,
 CAST(sum(pts) AS BIGINT) AS matchday_points FROM live_sides GROUP BY team_name, matchday))""",
]
MOMENTUM = """CASE WHEN recency_rank <= 5 THEN CASE WHEN ppg >= 2.2 THEN 'HOT' WHEN ppg >= 1.5 THEN 'STEADY'
 WHEN ppg >= 0.8 THEN 'COOLING' ELSE 'COLD' END END"""
FORM = [
    *LIVE_SIDES,
    f"""form AS (SELECT team_name, match_id, matchday, result, pts, gf, ga, last_5_form, recency_rank,
 round(ppg, 2) AS rolling_5_ppg, round(gfa, 2) AS rolling_5_goals_scored, round(gaa, 2) AS rolling_5_goals_conceded,
 {MOMENTUM} AS current_momentum FROM (SELECT *, CAST(sum(pts) OVER w AS DOUBLE) / count(*) OVER w AS ppg,
 CAST(sum(gf) OVER w AS DOUBLE) / count(*) OVER w AS gfa, CAST(sum(ga) OVER w AS DOUBLE) / count(*) OVER w AS gaa,
 string_agg(result, '') OVER w AS last_5_form,
 row_number() OVER (PARTITION BY team_name ORDER BY matchday DESC, match_id DESC) AS recency_rank FROM live_sides
 WINDOW w AS (PARTITION BY team_name ORDER BY matchday, match_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)))""",
]


def versions(stats: str = "last") -> list[str]:
    """Position history; ``stats`` as in the operator."""

    value = "max(x.{0})" if stats == "max" else "arg_max(x.{0}, x.matchday)"
    at_end = ", ".join(f"{value.format(c)} AS {c}" for c in ("points", "played", "goals_for", "goals_against", "goal_difference"))
    return [
        *LIVE_SIDES,
        """days AS (SELECT DISTINCT team_name, matchday FROM live_sides)""",
        # totals by a join with all earlier results, not by a window
        """sums AS (SELECT d.team_name, d.matchday, CAST(sum(s.pts) AS BIGINT) AS points, count(*) AS played,
 CAST(sum(s.gf) AS BIGINT) AS goals_for, CAST(sum(s.ga) AS BIGINT) AS goals_against,
 CAST(sum(s.gf - s.ga) AS BIGINT) AS goal_difference, max(s.match_date) AS until
 FROM days d JOIN live_sides s ON s.team_name = d.team_name AND s.matchday <= d.matchday GROUP BY d.team_name, d.matchday)""",
        """places AS (SELECT *, row_number() OVER (PARTITION BY matchday ORDER BY points DESC, goal_difference DESC,
 goals_for DESC, team_name) AS position FROM sums)""",
        # rows of one run have the same difference between their number in the team and in (team, position)
        """runs AS (SELECT *, row_number() OVER (PARTITION BY team_name ORDER BY matchday)
 - row_number() OVER (PARTITION BY team_name, position ORDER BY matchday) AS run FROM places)""",
        f"""spans AS (SELECT x.team_name, x.position, x.run, min(x.matchday) AS valid_from_matchday, max(x.matchday) AS valid_to_matchday,
 min(x.until) AS valid_from_date, max(x.until) AS valid_to_date, {at_end} FROM runs x GROUP BY x.team_name, x.position, x.run)""",
        """versions AS (SELECT v.* EXCLUDE (run), v.valid_to_matchday - v.valid_from_matchday + 1 AS matchdays_held,
 o.position AS prev_position, CASE WHEN o.position IS NULL THEN 'NEW' WHEN o.position > v.position THEN 'UP'
 WHEN o.position < v.position THEN 'DOWN' ELSE 'SAME' END AS movement,
 NOT EXISTS (SELECT 1 FROM days d WHERE d.team_name = v.team_name AND d.matchday > v.valid_to_matchday) AS is_current
 FROM spans v LEFT JOIN spans o ON o.team_name = v.team_name AND o.valid_to_matchday =
 (SELECT max(d.matchday) FROM days d WHERE d.team_name = v.team_name AND d.matchday < v.valid_from_matchday))""",
    ]


TIER = """CASE WHEN position <= 4 THEN 'TITLE CONTENDER' WHEN position <= 7 THEN 'EUROPEAN HOPEFUL'
 WHEN position <= 14 THEN 'MID-TABLE' WHEN position <= 17 THEN 'RELEGATION BATTLE' ELSE 'RELEGATION ZONE' END"""
TEAMS = [
    *LIVE_TABLE,
    *FORM,
    f"""teams AS (SELECT t.team_name, position, points, played, won, drawn, lost, goals_for, goals_against,
 goal_difference, qualification_zone, win_rate, goals_per_game, goals_conceded_per_game, s.current_form, {TIER} AS tier
 FROM live_table t LEFT JOIN (SELECT team_name, arg_min(last_5_form, recency_rank) AS current_form FROM form
 WHERE recency_rank <= (SELECT max(matchday) FROM form) GROUP BY team_name) s ON t.team_name = s.team_name)""",
]
PITCH = """CASE WHEN weather_code IN (0, 1) THEN 'Excellent' WHEN weather_code IN (2, 3) THEN 'Good'
 WHEN weather_code IN (45, 48) THEN 'Poor (Fog)' WHEN weather_code BETWEEN 51 AND 57 THEN 'Moderate (Drizzle)'
 WHEN weather_code BETWEEN 61 AND 67 THEN 'Poor (Rain)' WHEN weather_code BETWEEN 71 AND 77 THEN 'Poor (Snow)'
 WHEN weather_code BETWEEN 80 AND 86 THEN 'Poor (Showers)' WHEN weather_code >= 95 THEN 'Dangerous (Storm)'
 ELSE 'Unknown' END"""
TEMPERATURE = """CASE WHEN temperature_c < 0 THEN 'Freezing' WHEN temperature_c < 8 THEN 'Cold'
 WHEN temperature_c < 15 THEN 'Cool' WHEN temperature_c < 22 THEN 'Comfortable' WHEN temperature_c < 30 THEN 'Warm'
 ELSE 'Hot' END"""
WEATHER = [
    *TEAMS,
    cte("weather"),
    f"""stadiums AS (SELECT w.team_name, stadium_name, temperature_c, weather_code, fetched_at, reading,
 t.tier AS team_tier, t.position AS current_position, {PITCH} AS pitch_condition, {TEMPERATURE} AS temperature_class
 FROM {newest('weather', 'team_name', order='fetched_at DESC, reading DESC')} w
 LEFT JOIN teams t ON w.team_name = t.team_name)""",
]
EVENTS = [cte("match_events")]
GOAL = "event_type = 'Shot' AND outcome = 'Goal'"
ASSIST = "event_type = 'Pass' AND outcome = 'Goal'"
