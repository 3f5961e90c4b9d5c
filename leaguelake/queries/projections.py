"""Column functions over whole tables: one query per function."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.plans.adapters import cte, load, table
from leaguelake.queries.registry import (
    MOMENTUM,
    PITCH,
    STATUS,
    TEMPERATURE,
    TIER,
    WINNER,
    clean_club,
    query,
    with_ctes,
    zone,
)

# A club name as the season CSV or a feed spells it.
RAW_CLUB = """CASE home_team_id % 6 WHEN 0 THEN 'Man City' WHEN 1 THEN 'Spurs' WHEN 2 THEN 'Wolves' WHEN 3 THEN
 'AFC Bournemouth' WHEN 4 THEN 'Leeds United FC' ELSE home_team_name END"""


def projection(
    name: str,
    adapter: str,
    keys: list[str],
    inputs: dict[str, str],
    spark_columns: Callable[[], dict[str, Column]],
    sql_columns: dict[str, str],
) -> None:
    """Register a projection: ``inputs`` are read alike by both engines, the columns under test are not."""
    extra = "".join(f", {e} AS {n}" for n, e in inputs.items())
    outputs = ", ".join([*keys, *(f"{e} AS {n}" for n, e in sql_columns.items())])
    sql = with_ctes(cte(adapter), select=f"SELECT {outputs} FROM (SELECT *{extra} FROM {adapter})")

    @query(sql, name=name)
    def run(spark, sf_dir):
        df = load(spark, sf_dir, adapter).selectExpr("*", *[f"{e} AS {n}" for n, e in inputs.items()])
        return df.select(*keys, *[c.alias(n) for n, c in spark_columns().items()])


def sql_map(column: str, mapping: dict, default: str) -> str:
    def quoted(v: object) -> str:
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE {column} {cases} ELSE {default} END"


VERSION = ["match_id", "ingest_seq"]

projection(
    "normalize_team_name",
    "live_matches",
    VERSION,
    {},
    lambda: {"team": C.club_name("home_team_name"), "trimmed": C.club_name("away_team_name", trim=True)},
    {"team": clean_club("home_team_name"), "trimmed": f"trim({clean_club('away_team_name')})"},
)
projection(
    "map_team_name",
    "matches",
    ["match_id"],
    {"raw": RAW_CLUB},
    lambda: {
        "club": C.mapped("raw", values.CLUB_NAMES),
        "club_id": C.mapped(C.mapped("raw", values.CLUB_NAMES), values.CLUB_IDS, F.lit(values.UNKNOWN_CLUB_ID)),
    },
    {
        "club": sql_map("raw", values.CLUB_NAMES, "raw"),
        "club_id": sql_map(f"({sql_map('raw', values.CLUB_NAMES, 'raw')})", values.CLUB_IDS, "99"),
    },
)
projection(
    "status_bucket",
    "live_matches",
    VERSION,
    {},
    lambda: {"status": C.status_bucket("status")},
    {"status": STATUS},
)
projection(
    "winner_from_scores",
    "matches",
    ["match_id"],
    {},
    lambda: {"winner": C.winner("home_score", "away_score")},
    {"winner": WINNER},
)
projection(
    "side_results",
    "matches",
    ["match_id"],
    {"w": WINNER},
    lambda: {"home_result": C.side_result("w", "home"), "away_result": C.side_result("w", "away")},
    {
        "home_result": "CASE w WHEN 'HOME_TEAM' THEN 'W' WHEN 'DRAW' THEN 'D' WHEN 'AWAY_TEAM' THEN 'L' END",
        "away_result": "CASE w WHEN 'AWAY_TEAM' THEN 'W' WHEN 'DRAW' THEN 'D' WHEN 'HOME_TEAM' THEN 'L' END",
    },
)
projection(
    "points_and_indicators",
    "matches",
    ["match_id"],
    {},
    lambda: {
        "pts": C.points("home_score", "away_score"),
        "won": C.flag(F.col("home_score") > F.col("away_score")),
        "drawn": C.flag(F.col("home_score") == F.col("away_score")),
        "lost": C.flag(F.col("home_score") < F.col("away_score")),
    },
    {
        "pts": "CASE WHEN home_score > away_score THEN 3 WHEN home_score = away_score THEN 1 ELSE 0 END",
        "won": "CASE WHEN home_score > away_score THEN 1 ELSE 0 END",
        "drawn": "CASE WHEN home_score = away_score THEN 1 ELSE 0 END",
        "lost": "CASE WHEN home_score < away_score THEN 1 ELSE 0 END",
    },
)
projection(
    "safe_divide",
    "matches",
    ["match_id"],
    {},
    lambda: {"ratio": C.safe_divide("home_score", "away_score")},
    {
        "ratio": """CASE WHEN away_score IS NULL OR away_score = 0 THEN NULL
 ELSE CAST(home_score AS DOUBLE) / CAST(away_score AS DOUBLE) END"""
    },
)
projection(
    "guarded_rates",
    "live_standings",
    ["ingest_seq"],
    {},
    lambda: {
        "win_rate": C.ratio_or_zero("won", "played", 1, 100.0),
        "goals_per_game": C.ratio_or_zero("goals_for", "played", 2),
    },
    {
        "win_rate": "CASE WHEN played > 0 THEN round(won * CAST(100 AS DOUBLE) / played, 1) ELSE 0 END",
        "goals_per_game": "CASE WHEN played > 0 THEN round(goals_for * CAST(1 AS DOUBLE) / played, 2) ELSE 0 END",
    },
)
projection(
    "qualification_zone",
    "live_standings",
    ["ingest_seq"],
    {},
    lambda: {"live_zone": C.zone("position"), "batch_zone": C.zone("position", "midtable")},
    {"live_zone": zone(), "batch_zone": zone("'midtable'")},
)
projection("team_tier", "live_standings", ["ingest_seq"], {}, lambda: {"tier": C.tier("position")}, {"tier": TIER})
projection(
    "momentum_class",
    "live_standings",
    ["ingest_seq"],
    {"ppg": "CAST(points AS DOUBLE) / (played + 1)", "recency_rank": "position"},
    lambda: {"momentum": C.momentum("ppg", "recency_rank")},
    {"momentum": MOMENTUM},
)
projection(
    "pitch_condition",
    "weather",
    ["reading"],
    {},
    lambda: {
        "pitch_condition": C.pitch_condition("weather_code"),
        "description": C.weather_text("weather_code"),
    },
    {
        "pitch_condition": PITCH,
        "description": sql_map(
            "weather_code", values.WEATHER_CODES, "'Unknown (' || CAST(weather_code AS STRING) || ')'"
        ),
    },
)
projection(
    "temperature_class",
    "weather",
    ["reading"],
    {},
    lambda: {"temperature_class": C.temperature_class("temperature_c")},
    {"temperature_class": TEMPERATURE},
)
projection(
    "matchday_status",
    "live_standings",
    ["ingest_seq"],
    {"live_now": "lost % 2", "completed": "draw", "total": "won % 3"},
    lambda: {"matchday_status": C.matchday_status("live_now", "completed", "total")},
    {
        "matchday_status": """CASE WHEN live_now > 0 THEN 'LIVE' WHEN completed = total THEN 'COMPLETED'
 WHEN completed > 0 THEN 'IN_PROGRESS' ELSE 'UPCOMING' END"""
    },
)
projection(
    "active_window",
    "matches",
    ["match_id"],
    {"last_date": "CASE WHEN match_id % 9 = 0 THEN NULL ELSE match_date END"},
    lambda: {"is_active": C.in_window("match_date", "last_date", F.lit("1998-03-01").cast("date"), 30)},
    {
        "is_active": """coalesce(DATE '1998-03-01' BETWEEN match_date - INTERVAL 30 DAY
 AND last_date + INTERVAL 30 DAY, FALSE)"""
    },
)
projection(
    "json_field",
    "live_matches",
    VERSION,
    {},
    lambda: {"matchday": C.json_field("raw_json", "$.matchday"), "missing": C.json_field("raw_json", "$.none")},
    {"matchday": "CAST(json_extract_string(raw_json, '$.matchday') AS INT)", "missing": "CAST(NULL AS INT)"},
)
projection(
    "tolerant_cast",
    "matches",
    ["match_id"],
    {
        "text_date": "CASE WHEN match_id % 7 = 0 THEN 'n/a' ELSE CAST(match_date AS STRING) END",
        "text_number": """CASE match_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN NULL
 ELSE CAST(match_id AS STRING) END""",
    },
    lambda: {"a_date": F.col("text_date").try_cast("date"), "a_number": C.number_from_text("text_number")},
    {"a_date": "TRY_CAST(text_date AS DATE)", "a_number": "TRY_CAST(nullif(text_number, '') AS INT)"},
)
projection(
    "week_of_year",
    "live_matches",
    VERSION,
    {},
    lambda: {"week": C.monday_week("utc_date")},
    {"week": "CAST(strftime(utc_date, '%W') AS INT)"},
)
projection(
    "date_of_time",
    "live_matches",
    VERSION,
    {},
    lambda: {"match_date": F.to_date("ingested_at")},
    {"match_date": "CAST(ingested_at AS DATE)"},
)
projection(
    "minutes_since",
    "match_events",
    ["event_id"],
    {},
    lambda: {"minutes": C.minutes_since("ts", F.lit("2024-01-15 12:00:30").cast("timestamp_ntz"))},
    {"minutes": "greatest(0, date_diff('minute', ts, TIMESTAMP '2024-01-15 12:00:30'))"},
)
projection(
    "default_scores",
    "live_standings",
    ["ingest_seq"],
    {},
    lambda: {"gd": F.coalesce("goal_difference", F.col("goals_for") - F.col("goals_against"))},
    {"gd": "coalesce(goal_difference, goals_for - goals_against)"},
)
projection(
    "last_token_and_clock",
    "match_events",
    ["event_id"],
    {},
    lambda: {"last_name": C.last_token("player_name"), "clock": C.clock("minute", "second")},
    {
        "last_name": "string_split(player_name, ' ')[-1]",
        "clock": """CASE WHEN minute < 10 THEN '0' ELSE '' END || CAST(minute AS STRING) || ':'
 || CASE WHEN second < 10 THEN '0' ELSE '' END || CAST(second AS STRING)""",
    },
)
projection(
    "short_code",
    "matches",
    ["match_id"],
    {"raw": RAW_CLUB},
    lambda: {"code": C.short_code("raw")},
    {
        "code": """CASE raw WHEN 'AFC Bournemouth' THEN 'BOU' WHEN 'Leeds United FC' THEN 'LEE'
 ELSE upper(substr(raw, 1, 3)) END"""
    },
)
projection(
    "outcome_and_layer",
    "live_standings",
    ["ingest_seq"],
    {
        "passed": "won % 2 = 0",
        "severity": "CASE WHEN lost % 2 = 0 THEN 'critical' ELSE 'warning' END",
        "sch": "CASE draw WHEN 0 THEN 'raw' WHEN 1 THEN 'staging' ELSE 'mart' END",
    },
    lambda: {"outcome": C.outcome_label("passed", "severity"), "layer": C.layer("sch")},
    {
        "outcome": "CASE WHEN passed THEN 'pass' WHEN severity = 'critical' THEN 'fail' ELSE 'warn' END",
        "layer": "CASE sch WHEN 'raw' THEN 'Bronze' WHEN 'staging' THEN 'Silver' ELSE 'Gold' END",
    },
)


@query("SELECT event_id, round(value, 1) AS one, round(value / 7, 2) AS two FROM events")
def round_half_away(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id", C.round_to(v, 1).alias("one"), C.round_to(v / 7, 2).alias("two")
    )


@query(
    with_ctes(
        cte("matches"),
        select="""SELECT * EXCLUDE (competition_id) FROM matches WHERE match_status = 'available'
 AND season_id IN (2321, 2324) AND home_score IS NOT NULL AND away_score <= 2""",
    )
)
def filters_and_dropped_column(spark, sf_dir):
    return (
        load(spark, sf_dir, "matches")
        .filter(
            (F.col("match_status") == "available")
            & F.col("season_id").isin(2321, 2324)
            & F.col("home_score").isNotNull()
            & (F.col("away_score") <= 2)
        )
        .drop("competition_id")
    )
