"""The operators' input tables derived from the given tables.

Each adapter is a list of projections over one table, in SQL that Spark and ANSI engines read alike: ``load`` runs
it on Spark, ``cte`` gives the same projection as text for a comparison query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CLUB = """CASE {0} % 3 WHEN 0 THEN 'AFC Club ' || CAST({0} AS STRING)
 WHEN 1 THEN 'Club ' || CAST({0} AS STRING) || ' FC' ELSE 'Club ' || CAST({0} AS STRING) END"""
HOME = "CAST(o_custkey % 20 AS INT)"
AWAY = "CAST((o_custkey % 20 + 1 + o_orderkey % 19) % 20 AS INT)"
LIVE_HOME = "(l_orderkey % 20)"
LIVE_AWAY = "((l_orderkey % 20 + 1 + l_orderkey % 19) % 20)"
EVENT_CLOCK = "CAST(extract(hour FROM ts) * 60 + extract(minute FROM ts) AS INT)"
EVENT_TEAM = "((user_id + event_id % 2) % 20)"

ADAPTERS: dict[str, tuple[str, dict[str, str]]] = {
    # Orders as two-sided results; a tenth has no score yet.
    "matches": (
        "orders",
        {
            "match_id": "o_orderkey",
            "competition_id": "CAST(1 + o_orderkey % 2 AS INT)",
            "season_id": "CAST(2320 + o_orderkey % 5 AS INT)",
            "matchday": "CAST(1 + o_orderkey % 38 AS INT)",
            "match_date": "CAST(o_orderdate AS DATE)",
            "home_team_id": HOME,
            "home_team_name": CLUB.format(HOME),
            "away_team_id": AWAY,
            "away_team_name": CLUB.format(AWAY),
            "home_score": "CASE WHEN o_orderkey % 10 = 7 THEN NULL ELSE CAST(o_orderkey % 5 AS INT) END",
            "away_score": "CASE WHEN o_orderkey % 10 = 7 THEN NULL ELSE CAST((o_custkey + o_orderkey) % 4 AS INT) END",
            "match_status": "CASE WHEN o_orderstatus = 'P' THEN 'postponed' ELSE 'available' END",
        },
    ),
    # Order lines as ingested versions of live matches.
    "live_matches": (
        "lineitem",
        {
            "source": "CASE WHEN l_partkey % 10 = 0 THEN 'thesportsdb' ELSE 'football-data.org' END",
            "match_id": "CAST(l_orderkey AS STRING)",
            "competition": "'Premier League'",
            "season": "CAST(2020 + l_orderkey % 3 AS STRING)",
            "utc_date": "l_shipdate",
            "status": """CASE WHEN l_linestatus = 'F' THEN 'FINISHED' WHEN l_returnflag = 'A' THEN 'IN_PLAY'
 WHEN l_returnflag = 'R' THEN 'TIMED' WHEN l_linenumber % 2 = 0 THEN 'PAUSED' ELSE 'POSTPONED' END""",
            "minute": "CAST(NULL AS INT)",
            "home_team_name": CLUB.format(LIVE_HOME),
            "away_team_name": CLUB.format(LIVE_AWAY),
            "home_score": "CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_linenumber % 5 AS INT) END",
            "away_score": "CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_suppkey % 4 AS INT) END",
            "winner": "CASE WHEN l_linestatus = 'F' THEN 'HOME_TEAM' ELSE NULL END",
            "raw_json": """'{"id":' || CAST(l_orderkey AS STRING) || ',"matchday":'
 || CAST(1 + l_orderkey % 38 AS STRING) || '}'""",
            "ingested_at": "l_shipdate + l_linenumber * INTERVAL '1' HOUR",
            "ingest_seq": "l_partkey",
        },
    ),
    # Orders as ingested rows of the live standings.
    "live_standings": (
        "orders",
        {
            "source": "CASE WHEN o_orderkey % 7 = 0 THEN 'local-mart-fallback' ELSE 'football-data.org' END",
            "season": "'2025'",
            "position": "CAST(1 + o_custkey % 20 AS INT)",
            "team_name": CLUB.format("(o_custkey % 20)"),
            "played": "CAST(o_orderkey % 39 AS INT)",
            "won": "CAST(o_orderkey % 17 AS INT)",
            "draw": "CAST((o_orderkey % 39) % 3 AS INT)",
            "lost": "CAST(o_orderkey % 7 AS INT)",
            "goals_for": "CAST(o_orderkey % 83 AS INT)",
            "goals_against": "CAST(o_custkey % 61 AS INT)",
            "goal_difference": """CASE WHEN o_orderkey % 4 = 0 THEN NULL
 ELSE CAST(o_orderkey % 83 - o_custkey % 61 AS INT) END""",
            "points": "CAST(o_orderkey % 115 AS INT)",
            "form": "'W,D,L'",
            "ingested_at": "o_orderdate",
            "ingest_seq": "o_orderkey",
        },
    ),
    # Orders as ingested rows of a scorer table.
    "scorers": (
        "orders",
        {
            "player_id": "CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END",
            "player_name": "'Player ' || CAST(o_custkey AS STRING)",
            "team_name": CLUB.format("(o_custkey % 20)"),
            "goals": "CAST(o_orderkey % 31 AS INT)",
            "assists": "CAST(o_orderkey % 13 AS INT)",
            "goal_contributions": "CAST(o_orderkey % 31 + o_orderkey % 13 AS INT)",
            "matches_played": "CAST(o_orderkey % 39 AS INT)",
            "goals_per_game": "CAST(o_orderkey % 31 AS DOUBLE)",
            "ingested_at": "o_orderdate",
            "ingest_seq": "o_orderkey",
        },
    ),
    # Events as match events.
    "match_events": (
        "events",
        {
            "event_id": "event_id",
            "match_id": "user_id",
            "index_num": "event_id",
            "period": "CAST(1 + extract(day FROM ts) % 2 AS INT)",
            "minute": EVENT_CLOCK,
            "second": "CAST(floor(extract(second FROM ts)) AS INT)",
            "event_type": """CASE event_type WHEN 'click' THEN 'Pass' WHEN 'view' THEN 'Carry'
 WHEN 'purchase' THEN 'Shot' WHEN 'signup' THEN 'Ball Receipt*' ELSE 'Foul Committed' END""",
            "team_id": f"CAST({EVENT_TEAM} AS INT)",
            "team_name": CLUB.format(EVENT_TEAM),
            "player_id": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE (user_id * 7 + event_id) % 500 END",
            "player_name": """CASE WHEN event_id % 13 = 0 THEN NULL
 ELSE 'Player ' || CAST((user_id * 7 + event_id) % 500 AS STRING) END""",
            "outcome": "CASE WHEN value >= 60 THEN 'Goal' WHEN value >= 20 THEN 'Saved' ELSE NULL END",
            "ts": "ts",
        },
    ),
    # Events as weather readings per stadium.
    "weather": (
        "events",
        {
            "team_name": "'Club ' || CAST(user_id % 25 AS STRING)",
            "stadium_name": "'Stadium ' || CAST(user_id % 25 AS STRING)",
            "temperature_c": "CAST(event_id % 47 - 8 AS DOUBLE)",
            "weather_code": "CAST((event_id * 7 + user_id) % 101 AS INT)",
            "fetched_at": "ts",
            "reading": "event_id",
        },
    ),
}

# Newest version first; the last column makes the order unique.
NEWEST = ("-ingested_at", "-ingest_seq")
NEWEST_READING = ("-fetched_at", "-reading")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str, adapter: str) -> DataFrame:
    source, columns = ADAPTERS[adapter]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {name}" for name, e in columns.items()])


def cte(adapter: str) -> str:
    """``adapter AS (SELECT ...)``"""
    source, columns = ADAPTERS[adapter]
    return f"{adapter} AS (SELECT " + ", ".join(f"{e} AS {name}" for name, e in columns.items()) + f" FROM {source})"
