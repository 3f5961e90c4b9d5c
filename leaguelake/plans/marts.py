"""Silver and gold tables composed from the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.operators import quality
from leaguelake.operators.history import distinct_on, latest_per_key, scd1, scd2
from leaguelake.operators.joins import with_side_counts
from leaguelake.operators.ordered import global_row_number
from leaguelake.operators.results import cumulative, rolling_form, standings, unpivot_sides

NEWEST = ("-ingested_at",)
TABLE_ORDER = ["-points", "-goal_difference", "-goals_for", "team_id"]


# batch results ----------------------------------------------------------------------------------------------------


def clean_matches(matches: DataFrame, season_id: int | None = None) -> DataFrame:
    """Available matches, of one season if named, with parsed date and winner."""
    out = matches.filter(F.col("match_status") == "available")
    if season_id is not None:
        out = out.filter(F.col("season_id") == season_id)
    return out.withColumn("match_date", F.col("match_date").try_cast("date")).withColumn(
        "winner", C.winner("home_score", "away_score")
    )


def match_sides(matches: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return unpivot_sides(
        matches,
        {
            "team_id": ("home_team_id", "away_team_id"),
            "team_name": ("home_team_name", "away_team_name"),
        },
        keep,
    )


def rates(table: DataFrame) -> DataFrame:
    return table.withColumns(
        {
            "points_pct": C.share("points", F.col("played") * 3, 1, 100.0),
            "win_rate": C.share("won", "played", 1, 100.0),
            "goals_per_game": C.share("goals_for", "played", 2),
            "goals_conceded_per_game": C.share("goals_against", "played", 2),
        }
    )


def league_table(matches: DataFrame) -> DataFrame:
    """Ranked table with rates and qualification zones from match results."""
    table = standings(match_sides(matches))
    ranked = global_row_number(table, TABLE_ORDER, "position", whole=True)
    return rates(ranked).withColumn("qualification_zone", C.zone("position", "midtable"))


def recent_results(matches: DataFrame) -> DataFrame:
    """Matches with the result letter of each side."""
    return matches.select(
        "match_id",
        "matchday",
        "match_date",
        "home_team_id",
        "home_team_name",
        "away_team_id",
        "away_team_name",
        "home_score",
        "away_score",
        "winner",
        "match_status",
        C.side_result("winner", "home").alias("home_result"),
        C.side_result("winner", "away").alias("away_result"),
    )


def team_stats(matches: DataFrame) -> DataFrame:
    """League table with wins and matches counted over both sides."""
    return with_side_counts(league_table(matches), match_sides(matches))


def clean_scorers(scorers: DataFrame, order_by: Sequence[str] = NEWEST) -> DataFrame:
    return latest_per_key(scorers.filter(F.col("player_id").isNotNull()), ["player_id"], order_by)


SCORER_ORDER = ["-goals", "-assists", "player_id"]


def ranked_scorers(scorers: DataFrame, order_by: Sequence[str] = NEWEST) -> DataFrame:
    """All scorers with their rank."""
    return global_row_number(clean_scorers(scorers, order_by), SCORER_ORDER, "rank")


def top_scorers(scorers: DataFrame, n: int = 30, order_by: Sequence[str] = NEWEST) -> DataFrame:
    """The best ``n`` scorers, ranked after the top-n so that the ranking's single window sees ``n`` rows only."""
    order = [F.desc("goals"), F.desc("assists"), F.asc("player_id")]
    best = clean_scorers(scorers, order_by).orderBy(*order).limit(n)
    return best.select(
        F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"),
        "player_id",
        "player_name",
        "team_name",
        "goals",
        "assists",
        "goal_contributions",
        "matches_played",
        "goals_per_game",
        C.share("assists", "matches_played", 2).alias("assists_per_game"),
    )


# live feeds -------------------------------------------------------------------------------------------------------


def live_state(
    live_matches: DataFrame, source: str = values.PRIMARY_SOURCE, order_by: Sequence[str] = NEWEST
) -> DataFrame:
    """Latest version of each match, with clean names, status bucket and scores."""
    latest = latest_per_key(live_matches.filter(F.col("source") == source), ["match_id"], order_by)
    return clean_live(latest)


def clean_live(versions: DataFrame, *keep: str) -> DataFrame:
    return versions.select(
        "match_id",
        "utc_date",
        C.status_bucket("status").alias("status"),
        "minute",
        C.club_name("home_team_name").alias("home_team"),
        C.club_name("away_team_name").alias("away_team"),
        F.col("home_team_name").alias("home_team_raw"),
        F.col("away_team_name").alias("away_team_raw"),
        F.coalesce("home_score", F.lit(0)).alias("home_score"),
        F.coalesce("away_score", F.lit(0)).alias("away_score"),
        "winner",
        "competition",
        "season",
        C.monday_week("utc_date").alias("matchday_approx"),
        *(keep or ["ingested_at"]),
    )


def live_matches_mart(state: DataFrame) -> DataFrame:
    return state.drop("home_team_raw", "away_team_raw").withColumnRenamed("matchday_approx", "matchday")


def live_league_table(
    live_standings: DataFrame, source: str = values.PRIMARY_SOURCE, order_by: Sequence[str] = NEWEST
) -> DataFrame:
    """Latest standings row per team with rates and zones; the middle of the table has no zone."""
    latest = latest_per_key(live_standings.filter(F.col("source") == source), ["team_name"], order_by)
    return latest.select(
        "position",
        C.club_name("team_name").alias("team_name"),
        F.col("team_name").alias("team_name_raw"),
        "played",
        "won",
        F.col("draw").alias("drawn"),
        "lost",
        "goals_for",
        "goals_against",
        F.coalesce("goal_difference", F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        "points",
        "form",
        "season",
        "ingested_at",
        C.ratio_or_zero("won", "played", 1, 100.0).alias("win_rate"),
        C.ratio_or_zero("points", F.col("played") * 3, 1, 100.0).alias("points_pct"),
        C.ratio_or_zero("goals_for", "played", 2).alias("goals_per_game"),
        C.ratio_or_zero("goals_against", "played", 2).alias("goals_conceded_per_game"),
        C.zone("position").alias("qualification_zone"),
    )


def finished_results(
    live_matches: DataFrame, source: str = values.PRIMARY_SOURCE, order_by: Sequence[str] = NEWEST
) -> DataFrame:
    """Latest finished version of each match; the filter comes before the pick."""
    finished = (
        (F.col("source") == source) & (F.col("status") == "FINISHED") & F.col("home_score").isNotNull()
    )
    narrow = ["match_id", "raw_json", "home_score", "away_score", "utc_date", "home_team_name", "away_team_name"]
    picked = distinct_on(live_matches, ["match_id"], order_by, finished)
    return picked.select(*narrow).select(
        "match_id",
        C.json_field("raw_json", "$.matchday").alias("matchday"),
        "home_score",
        "away_score",
        "utc_date",
        F.to_date("utc_date").alias("match_date"),
        C.club_name("home_team_name").alias("home_team"),
        C.club_name("away_team_name").alias("away_team"),
    )


def live_sides(results: DataFrame, *keep: str) -> DataFrame:
    return unpivot_sides(results, {"team_name": ("home_team", "away_team")}, keep)


def points_race(results: DataFrame) -> DataFrame:
    """Points per team and matchday with their running total."""
    return cumulative(
        live_sides(results, "matchday"), ["team_name"], "matchday", "matchday_points", "pts", "cumulative_points"
    )


def form(results: DataFrame, size: int = 5, ranges: int | None = None) -> DataFrame:
    """Rolling form per team, ordered by matchday and match id."""
    sides = live_sides(results, "match_id", "matchday").drop("side")
    return rolling_form(sides, size=size, ranges=ranges)


def scd1_matches(
    live_matches: DataFrame, source: str = values.PRIMARY_SOURCE, order_by: Sequence[str] = NEWEST
) -> DataFrame:
    """Latest state of each match with its version history, over all ingested versions."""
    history = scd1(live_matches.filter(F.col("source") == source), ["match_id"], order_by)
    kept = ["first_seen_at", "last_updated_at", "update_count", "is_correction"]
    return live_matches_mart(clean_live(history, *kept))


def scd2_standings(results: DataFrame, stats: str = "last") -> DataFrame:
    return scd2(live_sides(results, "matchday", "match_date"), stats=stats)


def dim_matchdays(
    live_matches: DataFrame,
    as_of: Column,
    source: str = values.PRIMARY_SOURCE,
    order_by: Sequence[str] = NEWEST,
) -> DataFrame:
    """Schedule per matchday: counts by state, first and last kick-off, status and active window."""
    latest = distinct_on(live_matches, ["match_id"], order_by, F.col("source") == source)
    status = F.col("status")
    return (
        latest.withColumn("matchday", C.json_field("raw_json", "$.matchday"))
        .groupBy("matchday")
        .agg(
            F.min("utc_date").alias("first_kickoff"),
            F.max("utc_date").alias("last_kickoff"),
            F.count(F.lit(1)).alias("total_matches"),
            F.sum(C.flag(status == "FINISHED")).alias("completed"),
            F.sum(C.flag(status.isin(*values.OPEN_STATUSES))).alias("scheduled"),
            F.sum(C.flag(status.isin(*values.LIVE_STATUSES))).alias("live_now"),
        )
        .withColumns(
            {
                "matchday_start_date": F.to_date("first_kickoff"),
                "matchday_end_date": F.to_date("last_kickoff"),
                "matchday_status": C.matchday_status("live_now", "completed", "total_matches"),
                "is_active_window": C.in_window("first_kickoff", "last_kickoff", as_of),
            }
        )
    )


def season_stats(form_rows: DataFrame, form_pick: str = "last", within_matchdays: bool = False) -> DataFrame:
    """Season totals per team over all rows.

    ``form_pick="last"`` takes the newest form text, ``"max"`` the greatest text. ``within_matchdays`` keeps, like the
    reference, as many newest rows per team as the last matchday's number.
    """
    newest = F.max_by("last_5_form", -F.col("recency_rank"))
    rows = form_rows
    if within_matchdays:
        rows = rows.filter(F.col("recency_rank") <= form_rows.agg(F.max("matchday")).scalar())
    return (
        rows.groupBy("team_name")
        .agg(
            F.count(F.lit(1)).alias("total_matches"),
            F.count_if(F.col("result") == "W").alias("total_wins"),
            F.count_if(F.col("result") == "L").alias("total_losses"),
            F.sum("gf").alias("total_goals_scored"),
            F.sum("ga").alias("total_goals_conceded"),
            (F.max("last_5_form") if form_pick == "max" else newest).alias("current_form"),
        )
    )


def dim_teams(table: DataFrame, form_rows: DataFrame, form_pick: str = "last") -> DataFrame:
    """Live table rows with the current form and a tier."""
    return (
        table.join(season_stats(form_rows, form_pick).select("team_name", "current_form"), "team_name", "left")
        .select(
            "team_name",
            "position",
            "points",
            "played",
            "won",
            "drawn",
            "lost",
            "goals_for",
            "goals_against",
            "goal_difference",
            "qualification_zone",
            "win_rate",
            "goals_per_game",
            "goals_conceded_per_game",
            "current_form",
            C.tier("position").alias("tier"),
        )
    )


def stadium_weather(readings: DataFrame, teams: DataFrame, order_by: Sequence[str] = ("-fetched_at",)) -> DataFrame:
    """Latest reading per stadium with the team's tier and position and two condition classes."""
    latest = latest_per_key(readings, ["team_name"], order_by)
    context = teams.select(
        "team_name", F.col("tier").alias("team_tier"), F.col("position").alias("current_position")
    )
    return latest.join(context, "team_name", "left").withColumns(
        {
            "pitch_condition": C.pitch_condition("weather_code"),
            "temperature_class": C.temperature_class("temperature_c"),
        }
    )


def weather_summary(weather: DataFrame) -> DataFrame:
    """Venues by pitch condition and the mean temperature in degrees Fahrenheit (a missing reading counts as 0)."""
    condition = F.col("pitch_condition")
    celsius = F.coalesce("temperature_c", F.lit(0.0))
    return weather.agg(
        F.count_if(condition.isin("Excellent", "Good")).alias("good"),
        F.count_if(condition.contains("Moderate")).alias("moderate"),
        F.count_if(condition.contains("Poor")).alias("poor"),
        C.round_to(C.safe_divide(F.sum(celsius), F.count(F.lit(1))) * 9 / 5 + 32, 1).alias("avg_fahrenheit"),
    )


def live_match_monitor(
    live_matches: DataFrame, as_of: Column, order_by: Sequence[str] = NEWEST
) -> DataFrame:
    """Freshness over the latest version of each match of any source."""
    return quality.live_monitor(latest_per_key(live_matches, ["match_id"], order_by), as_of)
