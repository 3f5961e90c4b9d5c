"""Match events: player and match statistics, scorers, replay schedules and bundles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.operators.joins import enrich, present
from leaguelake.operators.ordered import OrderedRows, global_row_number, row_number_per

REPLAY_ORDER = ("period", "minute", "second", "index_num")


def is_goal() -> Column:
    return (F.col("event_type") == "Shot") & (F.col("outcome") == "Goal")


def is_assist() -> Column:
    return (F.col("event_type") == "Pass") & (F.col("outcome") == "Goal")


def goals(events: DataFrame) -> DataFrame:
    """Goal list; also usable on a stream."""
    return events.filter(is_goal())


def key_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin(*values.KEY_EVENTS))


def match_context(events: DataFrame, matches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Events with columns of their match; matches with very many events are spread over tasks."""
    return enrich(events, matches.select("match_id", *columns), "match_id", ["event_id"])


def player_match_stats(
    events: DataFrame, keys: Sequence[str] = ("match_id", "player_id", "player_name", "team_id", "team_name")
) -> DataFrame:
    """Distinct events per match, player and team."""
    return (
        events.filter(F.col("player_id").isNotNull())
        .groupBy(*keys)
        .agg(F.count_distinct("event_id").alias("event_count"))
    )


def goals_and_assists(
    events: DataFrame, keys: Sequence[str] = ("player_id", "player_name", "team_id", "team_name")
) -> DataFrame:
    """Players with at least one goal."""
    return (
        events.filter(F.col("player_id").isNotNull())
        .groupBy(*keys)
        .agg(F.count_if(is_goal()).alias("goals"), F.count_if(is_assist()).alias("assists"))
        .filter(F.col("goals") > 0)
    )


def scorers(events: DataFrame) -> DataFrame:
    """Ranked scorers from events: goals per player, name and team; assists per player over all teams.

    One scan: assists are counted at the finer grain and summed per player over the aggregated rows.
    """
    per_player = Window.partitionBy("player_id")
    stats = (
        events.filter(F.col("player_id").isNotNull())
        .groupBy("player_id", "player_name", "team_name")
        .agg(
            F.count_if(is_goal()).alias("goals"),
            F.count_if(is_assist()).alias("_assists"),
            F.count_distinct("match_id").alias("matches_played"),
        )
        .withColumn("assists", F.sum("_assists").over(per_player))
        .filter(F.col("goals") > 0)
        .select(
            "player_id",
            "player_name",
            "team_name",
            "goals",
            "assists",
            (F.col("goals") + F.col("assists")).alias("goal_contributions"),
            "matches_played",
            C.share("goals", "matches_played", 2).alias("goals_per_game"),
        )
    )
    order = ["-goals", "-assists", "player_id", "player_name", "team_name"]
    return global_row_number(stats, order, "rank", whole=True)


def match_stats(events: DataFrame) -> DataFrame:
    """Shots, passes, goals and key events per match and team."""
    return events.groupBy("match_id", "team_name").agg(
        F.count_if(F.col("event_type") == "Shot").alias("shots"),
        F.count_if(F.col("event_type") == "Pass").alias("passes"),
        F.count_if(is_goal()).alias("goals"),
        F.count_if(F.col("event_type").isin(*values.KEY_EVENTS)).alias("key_events"),
    )


def event_counts(events: DataFrame, *by: str) -> DataFrame:
    """Counts per group; also usable on a stream."""
    return events.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def replay_index(events: DataFrame, matches: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` matches with most events. Events are counted before the join, so no hot match is shuffled."""
    counts = event_counts(events, "match_id").withColumnRenamed("n", "event_count")
    return (
        counts.join(
            matches.select("match_id", "home_team_name", "away_team_name", "home_score", "away_score"), "match_id"
        )
        .orderBy(F.desc("event_count"), "match_id")
        .limit(n)
    )


def replay_events(events: DataFrame, index: DataFrame) -> DataFrame:
    """Events of the indexed matches with their place in the replay; one flat row per event."""
    chosen = present(events, index, ["match_id"])
    return row_number_per(chosen, ["match_id"], REPLAY_ORDER, "index")


def replay_schedule(
    events: DataFrame,
    speed: int = 10,
    order_by: Sequence[str] = REPLAY_ORDER,
    ranges: int | None = None,
) -> DataFrame:
    """When each event of a match is emitted.

    The delay is the match clock since the event before (never negative, the first counts from 0), divided by the
    speed (1 to 100); ``emit_ms`` is the sum of the delays so far.
    """
    speed = max(1, min(int(speed), 100))
    timed = events.withColumn("clock_seconds", F.col("minute") * 60 + F.col("second"))
    previous = F.coalesce(F.col("_before"), F.lit(0))
    return (
        OrderedRows(timed, order_by, ["match_id"], ranges)
        .previous(_before="clock_seconds")
        .derive(delay_seconds=F.greatest(F.lit(0), F.col("clock_seconds") - previous))
        .scan("index", "_back", _elapsed=("sum", "delay_seconds"))
        .result()
        .withColumn("total", F.col("index") + F.col("_back") - 1)
        .withColumn("emit_ms", F.col("_elapsed") * 1000.0 / speed)
        .drop("_elapsed", "_back", "_before")
    )
