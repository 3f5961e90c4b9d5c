"""Feeds: JSON payloads and CSV files to bronze rows.

A payload is one landed document. Elements are first read as raw text (``array<string>``), so every element keeps
its complete JSON - also fields that no schema names - and typed fields are then taken from that text.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.operators.ordered import global_row_number
from leaguelake.operators.results import infer_rounds

MATCH_PAYLOAD = "competition struct<name:string>, filters struct<season:string>, matches array<string>"
MATCH = """
    id string, utcDate string, status string, matchday int,
    homeTeam struct<name:string>, awayTeam struct<name:string>,
    score struct<winner:string, fullTime:struct<home:int, away:int>>
"""
FALLBACK_PAYLOAD = "events array<string>"
FALLBACK_EVENT = """
    idEvent string, strLeague string, strSeason string, dateEvent string, strTime string, strStatus string,
    strHomeTeam string, strAwayTeam string, intHomeScore string, intAwayScore string
"""
STANDINGS_PAYLOAD = """
    season struct<startDate:string>, competition struct<name:string>,
    standings array<struct<type:string, table:array<string>>>
"""
STANDING = """
    position int, team struct<name:string>, playedGames int, won int, draw int, lost int,
    goalsFor int, goalsAgainst int, goalDifference int, points int, form string
"""
WEATHER_PAYLOAD = """
    current struct<temperature_2m:double, relative_humidity_2m:double, wind_speed_10m:double,
                   precipitation:double, weather_code:int>
"""
SEASON_COLUMNS = ["Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG"]


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Landed JSON documents, one row per file, in the column ``payload``."""
    return spark.read.text(path, wholetext=True).withColumnRenamed("value", "payload")


def _elements(payloads: DataFrame, schema: str, elements: Column, element_schema: str) -> DataFrame:
    """One row per element: payload fields ``p``, raw text ``raw_json`` and parsed fields ``m``."""
    return (
        payloads.select(F.from_json("payload", schema).alias("p"))
        .select("p", F.explode(elements).alias("raw_json"))
        .withColumn("m", F.from_json("raw_json", element_schema))
    )


def _not_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_match_feed(payloads: DataFrame, source: str = values.PRIMARY_SOURCE) -> DataFrame:
    rows = _elements(payloads, MATCH_PAYLOAD, F.col("p.matches"), MATCH)
    return rows.select(
        F.lit(source).alias("source"),
        F.col("m.id").alias("match_id"),
        F.coalesce("p.competition.name", F.lit(values.DEFAULT_COMPETITION)).alias("competition"),
        F.coalesce(_not_empty(F.col("p.filters.season")), F.lit(values.DEFAULT_SEASON)).alias("season"),
        F.col("m.utcDate").try_cast("timestamp_ntz").alias("utc_date"),
        F.col("m.status").alias("status"),
        F.lit(None).cast("int").alias("minute"),
        F.col("m.homeTeam.name").alias("home_team_name"),
        F.col("m.awayTeam.name").alias("away_team_name"),
        F.col("m.score.fullTime.home").alias("home_score"),
        F.col("m.score.fullTime.away").alias("away_score"),
        F.col("m.score.winner").alias("winner"),
        "raw_json",
    )


def normalize_fallback_feed(payloads: DataFrame, source: str = values.FALLBACK_SOURCE) -> DataFrame:
    rows = _elements(payloads, FALLBACK_PAYLOAD, F.col("p.events"), FALLBACK_EVENT)

    def given(name: str, default: str) -> Column:
        return F.coalesce(_not_empty(F.col(f"m.{name}")), F.lit(default))

    both = F.concat(_not_empty(F.col("m.dateEvent")), F.lit("T"), _not_empty(F.col("m.strTime")))
    return rows.select(
        F.lit(source).alias("source"),
        F.col("m.idEvent").alias("match_id"),
        given("strLeague", values.DEFAULT_COMPETITION).alias("competition"),
        given("strSeason", values.DEFAULT_SEASON).alias("season"),
        both.try_cast("timestamp_ntz").alias("utc_date"),
        given("strStatus", "SCHEDULED").alias("status"),
        F.lit(None).cast("int").alias("minute"),
        F.col("m.strHomeTeam").alias("home_team_name"),
        F.col("m.strAwayTeam").alias("away_team_name"),
        C.number_from_text("m.intHomeScore").alias("home_score"),
        C.number_from_text("m.intAwayScore").alias("away_score"),
        F.lit(None).cast("string").alias("winner"),
        "raw_json",
    )


def normalize_standings_feed(payloads: DataFrame, source: str = values.PRIMARY_SOURCE) -> DataFrame:
    """Rows of the first TOTAL table of each payload."""
    totals = F.filter("p.standings", lambda s: s["type"] == "TOTAL")
    rows = _elements(payloads, STANDINGS_PAYLOAD, F.try_element_at(totals, F.lit(1))["table"], STANDING)
    fields = {
        "position": "position",
        "team_name": "team.name",
        "played": "playedGames",
        "won": "won",
        "draw": "draw",
        "lost": "lost",
        "goals_for": "goalsFor",
        "goals_against": "goalsAgainst",
        "goal_difference": "goalDifference",
        "points": "points",
        "form": "form",
    }
    return rows.select(
        F.lit(source).alias("source"),
        F.coalesce("p.competition.name", F.lit(values.DEFAULT_COMPETITION)).alias("competition"),
        F.coalesce("p.season.startDate", F.lit(values.DEFAULT_SEASON)).alias("season"),
        *[F.col(f"m.{path}").alias(name) for name, path in fields.items()],
        "raw_json",
    )


def standings_from_table(table: DataFrame, top: int | None = None) -> DataFrame:
    """The computed league table as standings rows: the fallback of the standings feed."""
    row = F.struct(
        "position",
        "team_name",
        "played",
        "won",
        F.col("drawn").alias("draw"),
        "lost",
        "goals_for",
        "goals_against",
        "goal_difference",
        "points",
    )
    rows = table if top is None else table.orderBy("position").limit(top)
    return (
        rows.select(row.alias("t"))
        .select(
            F.lit(values.TABLE_FALLBACK_SOURCE).alias("source"),
            F.lit(values.DEFAULT_COMPETITION).alias("competition"),
            F.lit(values.FALLBACK_SEASON).alias("season"),
            "t.*",
            F.lit(None).cast("string").alias("form"),
            F.to_json("t").alias("raw_json"),
        )
    )


def normalize_provider_matches(rows: DataFrame) -> DataFrame:
    """Provider match rows: missing ids and match weeks become 0, missing scores stay NULL."""

    def number(name: str, kind: str = "int") -> Column:
        return F.coalesce(F.col(name).cast(kind), F.lit(0).cast(kind))

    def text(name: str, default: str = "") -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(default))

    fields = [
        number("match_id", "long").alias("match_id"),
        number("competition_id").alias("competition_id"),
        text("competition").alias("competition_name"),
        number("season_id").alias("season_id"),
        text("season").alias("season_name"),
        F.to_date("match_date").alias("match_date"),
        text("kick_off", "00:00:00").alias("kick_off"),
        number("home_team_id").alias("home_team_id"),
        text("home_team").alias("home_team_name"),
        number("away_team_id").alias("away_team_id"),
        text("away_team").alias("away_team_name"),
        F.col("home_score").cast("int").alias("home_score"),
        F.col("away_score").cast("int").alias("away_score"),
        text("match_status", "available").alias("match_status"),
        number("match_week").alias("matchday"),
    ]
    return rows.select(*fields).withColumn("raw_json", F.to_json(F.struct("*"), {"ignoreNullFields": "false"}))


def normalize_events(rows: DataFrame) -> DataFrame:
    """Provider events: coordinates only from a pair, one sub type and one outcome out of pass and shot fields."""
    pair = F.size("location") >= 2

    def first_given(*names: str) -> Column:
        return F.coalesce(*[F.col(n) for n in names])

    return rows.select(
        F.col("id").alias("event_id"),
        "match_id",
        F.coalesce(F.col("index").cast("int"), F.lit(0)).alias("index_num"),
        *[F.coalesce(F.col(n).cast("int"), F.lit(0)).alias(n) for n in ("period", "minute", "second")],
        F.col("type").alias("event_type"),
        F.coalesce(F.col("team_id").cast("int"), F.lit(0)).alias("team_id"),
        F.col("team").alias("team_name"),
        F.col("player_id").cast("long").alias("player_id"),
        F.col("player").alias("player_name"),
        F.col("position").alias("position_name"),
        F.when(pair, F.get("location", 0)).cast("float").alias("location_x"),
        F.when(pair, F.get("location", 1)).cast("float").alias("location_y"),
        first_given("pass_type", "shot_type").alias("sub_type"),
        first_given("shot_outcome", "pass_outcome").alias("outcome"),
        F.lit("{}").alias("raw_json"),
    )


def normalize_lineups(rows: DataFrame) -> DataFrame:
    """One row per player from ``lineups`` (a map of team name to players); only the first position counts."""
    player = rows.select("match_id", F.explode("lineups").alias("team_name", "players")).select(
        "match_id", "team_name", F.explode("players").alias("p")
    )
    first = F.try_element_at("p.positions", F.lit(1))
    return player.select(
        "match_id",
        F.coalesce(F.col("p.team_id").cast("int"), F.lit(0)).alias("team_id"),
        "team_name",
        F.coalesce(F.col("p.player_id").cast("long"), F.lit(0).cast("long")).alias("player_id"),
        F.col("p.player_name").alias("player_name"),
        F.coalesce(F.col("p.jersey_number").cast("int"), F.lit(0)).alias("jersey_number"),
        F.nullif(first["position_id"].cast("int"), F.lit(0)).alias("position_id"),
        first["position"].alias("position_name"),
        F.lit("{}").alias("raw_json"),
    )


def normalize_weather(
    readings: DataFrame, stadiums: DataFrame, key: str = "team_name", names: Sequence[str] = ()
) -> DataFrame:
    """Current weather per venue; readings without a ``current`` block are dropped.

    ``readings`` has the venue key and the landed ``payload``; ``names`` are reported instead of the key.
    """
    current = readings.select("*", F.from_json("payload", WEATHER_PAYLOAD)["current"].alias("c")).filter(
        F.col("c").isNotNull()
    )
    code = F.coalesce("c.weather_code", F.lit(-1))
    return current.join(stadiums, key).select(
        *(names or [key]),
        "stadium_name",
        "latitude",
        "longitude",
        F.col("c.temperature_2m").alias("temperature_c"),
        F.col("c.relative_humidity_2m").alias("humidity_pct"),
        F.col("c.wind_speed_10m").alias("wind_speed_kmh"),
        F.col("c.precipitation").alias("precipitation_mm"),
        code.alias("weather_code"),
        C.weather_text(code).alias("weather_description"),
        *[c for c in readings.columns if c not in (key, "payload")],
    )


def first_date(c: str, formats: Sequence[str] = tuple(values.CSV_DATE_FORMATS)) -> Column:
    """The date by the first format that fits; two-digit years are 1969 to 2068."""

    def parsed(f: str) -> Column:
        date = F.to_date(F.try_to_timestamp(c, F.lit(f)))
        if "yyyy" in f:
            return date
        return F.when(F.year(date) > values.LAST_SHORT_YEAR, F.add_months(date, -1200)).otherwise(date)

    return F.coalesce(*[parsed(f) for f in formats])


def surrogate_ids(df: DataFrame, order_by: Sequence[str], name: str, first: int) -> DataFrame:
    """Ids ``first``, ``first + 1``, ... in a fixed order over the whole table."""
    return global_row_number(df, order_by, name).withColumn(name, F.col(name) + (first - 1))


def read_season_csv(spark: SparkSession, path: str, *more: str) -> DataFrame:
    """CSV rows by header name, with file and byte block as the coarse place of a row.

    Only the season columns and those named in ``more`` are read. ``_file`` and ``_block`` order rows across splits and ``_row`` inside one:
    the id grows with the position in its split, so it can serve as ``order_by`` of ``normalize_season_csv``.
    """
    rows = spark.read.csv(path, header=True, enforceSchema=False)
    return rows.select(
        *SEASON_COLUMNS,
        *more,
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def normalize_season_csv(
    rows: DataFrame,
    order_by: Sequence[str],
    names: Mapping[str, str] = values.CLUB_NAMES,
    ids: Mapping[str, int] = values.CLUB_IDS,
    constants: Mapping[str, object] = values.SEASON_CSV,
    first_id: int = values.FIRST_CSV_MATCH_ID,
) -> DataFrame:
    """Season results: full club names and ids, dates in two formats, rounds inferred from the dates.

    Ids follow ``order_by`` over all rows; rows without a home score get an id and count for the rounds, but are
    left out of the result.
    """
    dated = rows.withColumn("match_date", first_date("Date")).withColumn(
        "season_id", F.lit(constants["season_id"])
    )
    numbered = surrogate_ids(dated, order_by, "match_id", first_id)
    rounds = infer_rounds(numbered, ["season_id"], dates=dated)
    home, away = C.mapped("HomeTeam", names), C.mapped("AwayTeam", names)
    unknown = F.lit(values.UNKNOWN_CLUB_ID)
    home_score = C.number_from_text("FTHG", "double").cast("int")
    return rounds.filter(home_score.isNotNull()).select(
        "match_id",
        F.lit(constants["competition_id"]).alias("competition_id"),
        F.lit(values.DEFAULT_COMPETITION).alias("competition_name"),
        "season_id",
        F.lit(constants["season_name"]).alias("season_name"),
        "match_date",
        F.lit(constants["kick_off"]).alias("kick_off"),
        C.mapped(home, ids, unknown).alias("home_team_id"),
        home.alias("home_team_name"),
        C.mapped(away, ids, unknown).alias("away_team_id"),
        away.alias("away_team_name"),
        home_score.alias("home_score"),
        C.number_from_text("FTAG", "double").cast("int").alias("away_score"),
        F.lit("available").alias("match_status"),
        "matchday",
        F.lit("{}").alias("raw_json"),
    )


def scorer_dim(
    rows: DataFrame, order_by: Sequence[str] = ("rank",), first_id: int = values.FIRST_SCORER_ID
) -> DataFrame:
    """Scorer table with ids, goal contributions and per-game rates (0 without matches)."""
    return surrogate_ids(rows, order_by, "player_id", first_id).select(
        (F.col("player_id") - (first_id - 1)).alias("rank"),
        "player_id",
        "player_name",
        "team_name",
        "goals",
        "assists",
        (F.col("goals") + F.col("assists")).alias("goal_contributions"),
        "matches_played",
        C.ratio_or_zero("goals", "matches_played", 2).alias("goals_per_game"),
        C.ratio_or_zero("assists", "matches_played", 2).alias("assists_per_game"),
    )


def pick_season(
    competitions: DataFrame, competition_id: int, wanted: str = "2023/2024", wanted_id: int = 281
) -> DataFrame:
    """The wanted season of a competition, else the one with the highest id."""
    hit = F.coalesce(F.col("season_name").contains(wanted) | (F.col("season_id") == wanted_id), F.lit(False))
    return (
        competitions.filter(F.col("competition_id") == competition_id)
        .orderBy(hit.desc(), F.col("season_id").desc(), "season_name")
        .limit(1)
    )
