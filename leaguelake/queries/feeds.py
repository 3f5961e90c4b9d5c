"""Feed payloads and files derived from the given tables, read back through the feed operators.

A payload holds at most ``PER_PAYLOAD`` elements, so their number grows with the table and their size does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.plans import marts
from leaguelake.plans.adapters import cte, load, table
from leaguelake.queries import league
from leaguelake.queries.projections import RAW_CLUB, sql_map
from leaguelake.queries.registry import CLEAN, LEAGUE, query, with_ctes
from leaguelake.session import new_folder
from leaguelake.sources import feeds

PER_PAYLOAD = 50


def payloads(rows: DataFrame, key: str, element, name: str, *head) -> DataFrame:
    """JSON documents ``{..head, name: [elements]}`` of at most ``PER_PAYLOAD`` consecutive keys."""
    chunk = F.floor(F.col(key) / PER_PAYLOAD).alias("chunk")
    grouped = rows.groupBy(chunk).agg(F.sort_array(F.collect_list(element)).alias(name))
    return grouped.select(F.to_json(F.struct(*head, name)).alias("payload"))


def match_payloads(spark, sf_dir):
    element = F.struct(
        F.col("match_id").alias("id"),
        F.concat(F.col("match_date").cast("string"), F.lit("T15:00:00Z")).alias("utcDate"),
        F.when(F.col("home_score").isNull(), "TIMED").otherwise("FINISHED").alias("status"),
        "matchday",
        F.struct(F.col("home_team_id").alias("id"), F.col("home_team_name").alias("name")).alias("homeTeam"),
        F.struct(F.col("away_team_id").alias("id"), F.col("away_team_name").alias("name")).alias("awayTeam"),
        F.struct(
            C.winner("home_score", "away_score").alias("winner"),
            F.struct(F.col("home_score").alias("home"), F.col("away_score").alias("away")).alias("fullTime"),
        ).alias("score"),
    )
    competition = F.when(F.col("chunk") % 2 == 0, F.struct(F.lit("Second League").alias("name"))).alias("competition")
    filters = F.struct(F.when(F.col("chunk") % 3 == 0, "2024").alias("season")).alias("filters")
    return payloads(load(spark, sf_dir, "matches"), "match_id", element, "matches", competition, filters)


CHUNK = "CAST(floor(match_id / 50) AS BIGINT)"


@query(
    with_ctes(
        *CLEAN,
        select=f"""SELECT 'football-data.org' AS source, CAST(match_id AS STRING) AS match_id,
 CASE WHEN {CHUNK} % 2 = 0 THEN 'Second League' ELSE 'Premier League' END AS competition,
 CASE WHEN {CHUNK} % 3 = 0 THEN '2024' ELSE 'current' END AS season,
 CAST(match_date AS TIMESTAMP) + INTERVAL 15 HOUR AS utc_date,
 CASE WHEN home_score IS NULL THEN 'TIMED' ELSE 'FINISHED' END AS status, CAST(NULL AS INT) AS minute,
 home_team_name, away_team_name, home_score, away_score,
 CASE WHEN home_score > away_score THEN 'HOME_TEAM' WHEN away_score > home_score THEN 'AWAY_TEAM'
 WHEN home_score = away_score THEN 'DRAW' END AS winner, CAST(match_id AS STRING) AS json_id,
 CAST(away_team_id AS STRING) AS json_away_id FROM matches""",
    )
)
def match_feed(spark, sf_dir):
    rows = feeds.normalize_match_feed(match_payloads(spark, sf_dir))
    return rows.select(
        *[c for c in rows.columns if c != "raw_json"],
        F.get_json_object("raw_json", "$.id").alias("json_id"),
        F.get_json_object("raw_json", "$.awayTeam.id").alias("json_away_id"),
    )


@query(
    with_ctes(
        cte("matches"),
        select="""SELECT 'thesportsdb' AS source, CAST(match_id AS STRING) AS match_id, CASE WHEN match_id % 3 = 0 THEN
 'Premier League' ELSE 'Cup' END AS competition, CASE WHEN match_id % 5 = 0 THEN 'current' ELSE '2024-2025' END AS season,
 CASE WHEN match_id % 4 = 0 THEN NULL ELSE CAST(match_date AS TIMESTAMP) + INTERVAL 12 HOUR + INTERVAL 30 MINUTE END
 AS utc_date, CASE WHEN match_id % 6 = 0 THEN 'SCHEDULED' ELSE 'Match Finished' END AS status,
 CAST(NULL AS INT) AS minute, home_team_name, away_team_name,
 CASE WHEN match_id % 7 = 0 THEN NULL ELSE home_score END AS home_score, away_score,
 CAST(NULL AS VARCHAR) AS winner FROM matches""",
    )
)
def fallback_feed(spark, sf_dir):
    number = F.col("match_id")

    def unless(divisor: int, value) -> object:
        return F.when(number % divisor != 0, value)

    element = F.struct(
        number.cast("string").alias("idEvent"),
        unless(3, F.lit("Cup")).alias("strLeague"),
        F.when(number % 5 == 0, "").otherwise("2024-2025").alias("strSeason"),
        F.col("match_date").cast("string").alias("dateEvent"),
        unless(4, F.lit("12:30:00")).alias("strTime"),
        unless(6, F.lit("Match Finished")).alias("strStatus"),
        F.col("home_team_name").alias("strHomeTeam"),
        F.col("away_team_name").alias("strAwayTeam"),
        F.when(number % 7 == 0, "").otherwise(F.col("home_score").cast("string")).alias("intHomeScore"),
        F.col("away_score").cast("string").alias("intAwayScore"),
    )
    rows = payloads(load(spark, sf_dir, "matches"), "match_id", element, "events")
    return feeds.normalize_fallback_feed(rows).drop("raw_json")


STANDING_FIELDS = {
    "position": "position",
    "playedGames": "played",
    "won": "won",
    "draw": "draw",
    "lost": "lost",
    "goalsFor": "goals_for",
    "goalsAgainst": "goals_against",
    "goalDifference": "goal_difference",
    "points": "points",
    "form": "form",
}


@query(
    with_ctes(
        cte("live_standings"),
        select="""SELECT 'football-data.org' AS source, 'Premier League' AS competition, '2025-08-15' AS season, position,
 team_name, played, won, draw, lost, goals_for, goals_against, goal_difference, points, form FROM live_standings""",
    )
)
def standings_feed(spark, sf_dir):
    """Each payload has a HOME table before the TOTAL table; only the latter counts."""
    element = F.struct(
        F.struct(F.col("team_name").alias("name")).alias("team"),
        *[F.col(c).alias(name) for name, c in STANDING_FIELDS.items()],
    )
    home = F.struct(F.lit("HOME").alias("type"), F.slice("rows", 1, 2).alias("table"))
    total = F.struct(F.lit("TOTAL").alias("type"), F.col("rows").alias("table"))
    grouped = (
        load(spark, sf_dir, "live_standings")
        .groupBy(F.floor(F.col("ingest_seq") / PER_PAYLOAD).alias("chunk"))
        .agg(F.collect_list(element).alias("rows"))
    )
    season = F.struct(F.lit("2025-08-15").alias("startDate")).alias("season")
    documents = grouped.select(
        F.to_json(F.struct(season, F.array(home, total).alias("standings"))).alias("payload")
    )
    return feeds.normalize_standings_feed(documents).drop("raw_json")


@query(
    with_ctes(
        *LEAGUE,
        select="""SELECT 'local-mart-fallback' AS source, 'Premier League' AS competition, '2023/24' AS season, position,
 team_name, played, won, drawn AS draw, lost, goals_for, goals_against, goal_difference, points,
 CAST(NULL AS VARCHAR) AS form FROM league""",
    )
)
def standings_from_table(spark, sf_dir):
    return feeds.standings_from_table(league.table(spark, sf_dir)).drop("raw_json")


RAW_AWAY = RAW_CLUB.replace("home_team", "away_team")
HOME_NAME, AWAY_NAME = (sql_map(f"({c})", values.CLUB_NAMES, f"({c})") for c in (RAW_CLUB, RAW_AWAY))
CSV_SQL = with_ctes(
    cte("matches"),
    """dated AS (SELECT *, CASE WHEN match_id % 97 = 0 THEN NULL ELSE match_date END AS d FROM matches)""",
    "days AS (SELECT d, count(*) AS n, row_number() OVER (ORDER BY d) AS i FROM dated WHERE d IS NOT NULL GROUP BY d)",
    """folded AS (SELECT d, i, 1 AS round, n AS played FROM days WHERE i = 1 UNION ALL SELECT y.d, y.i,
 CASE WHEN y.d - f.d > 3 AND f.played >= 8 THEN f.round + 1 ELSE f.round END,
 CASE WHEN y.d - f.d > 3 AND f.played >= 8 THEN y.n ELSE f.played + y.n END FROM folded f JOIN days y ON y.i = f.i + 1)""",
    select=f"""SELECT 10000 + row_number() OVER (ORDER BY match_id) AS match_id, home_score, away_score,
 dated.d AS match_date, 2324 AS competition_id, 'Premier League' AS competition_name, 2324 AS season_id,
 '2023/2024' AS season_name, '15:00:00' AS kick_off, {sql_map(f'({HOME_NAME})', values.CLUB_IDS, '99')} AS home_team_id,
 {HOME_NAME} AS home_team_name, {sql_map(f'({AWAY_NAME})', values.CLUB_IDS, '99')} AS away_team_id,
 {AWAY_NAME} AS away_team_name, 'available' AS match_status, coalesce(round, 1) AS matchday
 FROM dated LEFT JOIN folded ON folded.d = dated.d""",
    recursive=True,
)


@query(f"SELECT * FROM ({CSV_SQL}) WHERE home_score IS NOT NULL")
def season_csv(spark, sf_dir):
    """Matches written as CSV with dates in two formats, then read as a season file."""
    path = new_folder(spark, "season-csv")
    number = F.col("match_id")
    text_date = C.choose(
        (number % 97 == 0, "unknown"),
        (number % 2 == 0, F.date_format("match_date", "dd/MM/yyyy")),
        default=F.date_format("match_date", "dd/MM/yy"),
    )
    load(spark, sf_dir, "matches").select(
        F.col("match_id").alias("Seq"),
        text_date.alias("Date"),
        F.expr(RAW_CLUB).alias("HomeTeam"),
        F.expr(RAW_AWAY).alias("AwayTeam"),
        F.col("home_score").alias("FTHG"),
        F.col("away_score").alias("FTAG"),
    ).write.csv(path, header=True)
    rows = feeds.read_season_csv(spark, path, "Seq").withColumn("Seq", F.col("Seq").cast("long"))
    return feeds.normalize_season_csv(rows, ["Seq"]).drop("raw_json")


@query("SELECT o_orderkey, o_orderdate, 10000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id FROM orders")
def surrogate_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return feeds.surrogate_ids(rows, ["o_orderdate", "o_orderkey"], "id", values.FIRST_CSV_MATCH_ID)


@query(
    with_ctes(
        cte("matches"),
        select="""SELECT match_id, competition_id, '' AS competition_name,
 CASE WHEN match_id % 3 = 0 THEN 0 ELSE season_id END AS season_id, CAST(season_id AS STRING) AS season_name,
 match_date, '00:00:00' AS kick_off, home_team_id, home_team_name, away_team_id, away_team_name, home_score,
 away_score, match_status, CASE WHEN matchday % 5 = 0 THEN 0 ELSE matchday END AS matchday,
 CAST(match_id AS STRING) AS json_id, home_score IS NULL AS json_null_kept FROM matches""",
    )
)
def provider_matches(spark, sf_dir):
    rows = load(spark, sf_dir, "matches").selectExpr(
        "match_id",
        "competition_id",
        "CAST(NULL AS STRING) AS competition",
        "CASE WHEN match_id % 3 = 0 THEN NULL ELSE season_id END AS season_id",
        "season_id AS season",
        "match_date",
        "CAST(NULL AS STRING) AS kick_off",
        "home_team_id",
        "home_team_name AS home_team",
        "away_team_id",
        "away_team_name AS away_team",
        "home_score",
        "away_score",
        "match_status",
        "CASE WHEN matchday % 5 = 0 THEN NULL ELSE matchday END AS match_week",
    )
    out = feeds.normalize_provider_matches(rows)
    return out.withColumns(
        {
            "json_id": F.get_json_object("raw_json", "$.match_id"),
            "json_null_kept": F.col("raw_json").contains('"home_score":null'),
        }
    ).drop("raw_json")


@query(
    with_ctes(
        cte("match_events"),
        select="""SELECT CAST(event_id AS STRING) AS event_id, match_id, CAST(index_num AS INT) AS index_num, period, minute,
 second, event_type, team_id, team_name, player_id, player_name,
 CASE WHEN event_id % 2 = 0 THEN 'Wing' ELSE NULL END AS position_name,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 120 AS FLOAT) END AS location_x,
 CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST(event_id % 80 AS FLOAT) END AS location_y,
 CASE WHEN event_id % 4 = 0 THEN 'Corner' WHEN event_id % 4 = 1 THEN 'Volley' ELSE NULL END AS sub_type,
 coalesce(outcome, CASE WHEN event_id % 5 = 0 THEN 'Incomplete' ELSE NULL END) AS outcome FROM match_events""",
    )
)
def provider_events(spark, sf_dir):
    rows = load(spark, sf_dir, "match_events").selectExpr(
        "CAST(event_id AS STRING) AS id",
        "match_id",
        "index_num AS index",
        "period",
        "minute",
        "second",
        "event_type AS type",
        "team_id",
        "team_name AS team",
        "player_id",
        "player_name AS player",
        "CASE WHEN event_id % 2 = 0 THEN 'Wing' ELSE NULL END AS position",
        """CASE WHEN event_id % 3 = 0 THEN array(CAST(event_id AS DOUBLE))
 ELSE array(CAST(event_id % 120 AS DOUBLE), CAST(event_id % 80 AS DOUBLE)) END AS location""",
        "CASE WHEN event_id % 4 = 0 THEN 'Corner' ELSE NULL END AS pass_type",
        "CASE WHEN event_id % 4 = 1 THEN 'Volley' ELSE NULL END AS shot_type",
        "outcome AS shot_outcome",
        "CASE WHEN event_id % 5 = 0 THEN 'Incomplete' ELSE NULL END AS pass_outcome",
    )
    return feeds.normalize_events(rows).drop("raw_json")


@query(
    """SELECT CAST(o_orderkey AS BIGINT) AS match_id, CAST(c.c_nationkey AS INT) AS team_id,
 'Team ' || CAST(o_orderkey % 2 AS STRING) AS team_name, o_custkey AS player_id, c.c_name AS player_name,
 CASE WHEN c.c_custkey % 4 = 0 THEN 0 ELSE CAST(c.c_custkey % 99 AS INT) END AS jersey_number,
 CASE WHEN c.c_custkey % 3 = 0 OR c.c_custkey % 20 = 0 THEN NULL ELSE CAST(c.c_custkey % 20 AS INT) END AS position_id,
 CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE 'Left Back' END AS position_name
 FROM orders JOIN customer c ON o_custkey = c_custkey"""
)
def lineups(spark, sf_dir):
    positions = """CASE WHEN c_custkey % 3 = 0 THEN array() ELSE array(
 named_struct('position_id', c_custkey % 20, 'position', 'Left Back'),
 named_struct('position_id', 99L, 'position', 'Later')) END"""
    player = f"""named_struct('team_id', c_nationkey, 'player_id', o_custkey, 'player_name', c_name,
 'jersey_number', CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey % 99 END, 'positions', {positions})"""
    rows = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
        .selectExpr(
            "o_orderkey AS match_id",
            f"map(concat('Team ', CAST(o_orderkey % 2 AS STRING)), array({player})) AS lineups",
        )
    )
    return feeds.normalize_lineups(rows).drop("raw_json")


WEATHER_TEXT = sql_map("code", values.WEATHER_CODES, "'Unknown (' || CAST(code AS STRING) || ')'")


@query(
    f"""SELECT s_name AS team_name, s_name || ' Park' AS stadium_name, s_acctbal AS latitude, s_acctbal + 1 AS longitude,
 CAST(event_id % 40 AS DOUBLE) AS temperature_c, CAST(50 AS DOUBLE) AS humidity_pct,
 CAST(event_id % 30 AS DOUBLE) AS wind_speed_kmh, CAST(0 AS DOUBLE) AS precipitation_mm, code AS weather_code,
 {WEATHER_TEXT} AS weather_description, ts AS fetched_at FROM (SELECT *, CASE WHEN event_id % 9 = 0 THEN -1
 ELSE CAST(event_id % 101 AS INT) END AS code FROM events) JOIN supplier ON s_suppkey = user_id % 100
 WHERE event_id % 6 != 0"""
)
def weather_feed(spark, sf_dir):
    """A sixth of the payloads have no ``current`` block, a ninth no weather code."""
    current = F.struct(
        (F.col("event_id") % 40).cast("double").alias("temperature_2m"),
        F.lit(50.0).alias("relative_humidity_2m"),
        (F.col("event_id") % 30).cast("double").alias("wind_speed_10m"),
        F.lit(0.0).alias("precipitation"),
        F.when(F.col("event_id") % 9 != 0, F.col("event_id") % 101).alias("weather_code"),
    )
    payload = F.to_json(
        F.struct(F.lit(1.0).alias("latitude"), F.when(F.col("event_id") % 6 != 0, current).alias("current"))
    )
    readings = table(spark, sf_dir, "events").select(
        (F.col("user_id") % 100).alias("s_suppkey"), payload.alias("payload"), F.col("ts").alias("fetched_at")
    )
    stadiums = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey",
        "s_name AS team_name",
        "s_name || ' Park' AS stadium_name",
        "s_acctbal AS latitude",
        "s_acctbal + 1 AS longitude",
    )
    return feeds.normalize_weather(readings, stadiums, "s_suppkey", ["team_name"])


@query(
    with_ctes(
        cte("scorers"),
        select="""SELECT rank, 50000 + rank AS player_id, player_name, team_name, goals, assists,
 goals + assists AS goal_contributions, matches_played, CASE WHEN matches_played > 0
 THEN round(CAST(goals AS DOUBLE) / matches_played, 2) ELSE 0 END AS goals_per_game, CASE WHEN matches_played > 0
 THEN round(CAST(assists AS DOUBLE) / matches_played, 2) ELSE 0 END AS assists_per_game
 FROM (SELECT *, row_number() OVER (ORDER BY ingest_seq) AS rank FROM scorers)""",
    )
)
def scorer_dim(spark, sf_dir):
    return feeds.scorer_dim(load(spark, sf_dir, "scorers"), ["ingest_seq"])


@query(
    """SELECT o_custkey AS competition_id, o_orderkey AS season_id, o_orderpriority AS season_name FROM orders
 WHERE o_custkey = 7 ORDER BY (o_orderpriority LIKE '%HIGH%') DESC, o_orderkey DESC LIMIT 1"""
)
def preferred_season(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS competition_id", "o_orderkey AS season_id", "o_orderpriority AS season_name"
    )
    return feeds.pick_season(rows, 7, "HIGH", -1)


@query(with_ctes(*CLEAN, select="SELECT * FROM clean WHERE season_id = 2324"))
def clean_matches(spark, sf_dir):
    return marts.clean_matches(load(spark, sf_dir, "matches"), season_id=2324)
