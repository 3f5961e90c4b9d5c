"""Two-sided results: sides, standings, cumulative points, form, rounds and reshapes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.functions import columns as C
from leaguelake.operators.ordered import OrderedRows, sort_columns


def unpivot_sides(
    matches: DataFrame,
    entity: Mapping[str, tuple[str, str]],
    keep: Sequence[str] = (),
    scores: tuple[str, str] = ("home_score", "away_score"),
) -> DataFrame:
    """One row per side of a two-sided record, from a single scan.

    ``entity`` maps an output column to its (home, away) columns, e.g. ``{"team": ("home_team", "away_team")}``.
    A side whose score is missing is left out.
    """
    home, away = scores

    def side(name: str, i: int, scored: str, conceded: str) -> Column:
        fields = [F.col(pair[i]).alias(out) for out, pair in entity.items()]
        return F.struct(
            F.lit(name).alias("side"), *fields, F.col(scored).alias("gf"), F.col(conceded).alias("ga")
        )

    both = F.explode(F.array(side("home", 0, home, away), side("away", 1, away, home)))
    return (
        matches.select(*keep, both.alias("_side"))
        .select(*keep, "_side.*")
        .filter(F.col("gf").isNotNull())
        .withColumns({"pts": C.points("gf", "ga"), "result": C.result("gf", "ga")})
    )


def standings(sides: DataFrame, keys: Sequence[str] = ("team_id", "team_name")) -> DataFrame:
    """Played, won, drawn, lost, points and goals per entity; one partial and one final aggregate."""
    return sides.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("played"),
        F.sum(C.flag(F.col("gf") > F.col("ga"))).alias("won"),
        F.sum(C.flag(F.col("gf") == F.col("ga"))).alias("drawn"),
        F.sum(C.flag(F.col("gf") < F.col("ga"))).alias("lost"),
        F.sum("pts").alias("points"),
        F.sum("gf").alias("goals_for"),
        F.sum("ga").alias("goals_against"),
        (F.sum("gf") - F.sum("ga")).alias("goal_difference"),
    )


def cumulative(df: DataFrame, keys: Sequence[str], order: str, total: str, value: str, name: str) -> DataFrame:
    """Sum of ``value`` per (keys, order) as ``total`` and its running sum as ``name``.

    Equal order values form one step, as in a range frame.
    """
    steps = df.groupBy(*keys, order).agg(F.sum(value).alias(total))
    return OrderedRows(steps, [order], keys, whole=True).running(**{name: ("sum", total)}).result()


def rolling_form(
    sides: DataFrame,
    entity: str = "team_name",
    order_by: Sequence[str] = ("matchday", "match_id"),
    size: int = 5,
    ranges: int | None = None,
) -> DataFrame:
    """Rolling points, goals and form text over the last ``size`` results of each entity, with recency and momentum."""
    rows = (
        OrderedRows(sides, order_by, [entity], ranges)
        .rolling(
            size,
            _n=F.count(F.lit(1)),
            _pts=F.sum("pts"),
            _gf=F.sum("gf"),
            _ga=F.sum("ga"),
            _form=F.collect_list("result"),
        )
        .number("_number", from_end="recency_rank")
        .result()
    )
    mean = {c: C.safe_divide(f"_{c}", "_n") for c in ("pts", "gf", "ga")}
    return rows.select(
        *sides.columns,
        F.array_join("_form", "").alias("last_5_form"),
        "recency_rank",
        C.round_to(mean["pts"], 2).alias("rolling_5_ppg"),
        C.round_to(mean["gf"], 2).alias("rolling_5_goals_scored"),
        C.round_to(mean["ga"], 2).alias("rolling_5_goals_conceded"),
        C.momentum(mean["pts"], "recency_rank", size).alias("current_momentum"),
    )


def recent_form(
    sides: DataFrame,
    keys: Sequence[str] = ("team_id", "team_name"),
    order_by: Sequence[str] = ("-match_date", "-match_id"),
    size: int = 5,
    per_side: bool = True,
) -> DataFrame:
    """Form text, oldest result first, of the last ``size`` results.

    ``per_side`` ranks home and away results apart (up to twice ``size`` results, home and away interleaved by
    rank); otherwise the last ``size`` results of either side count. Only ranked rows are collected.
    """
    rank = F.row_number().over(
        Window.partitionBy(*keys, *(["side"] if per_side else [])).orderBy(*sort_columns(order_by))
    )
    results = F.array_sort(F.collect_list(F.struct((-F.col("_rank")).alias("rank"), "side", "result")))
    return (
        sides.withColumn("_rank", rank)
        .filter(F.col("_rank") <= size)
        .groupBy(*keys)
        .agg(
            F.array_join(F.transform(results, lambda r: r["result"]), ",").alias("form_string"),
            F.count(F.lit(1)).alias("recent_matches"),
        )
    )


def infer_rounds(
    matches: DataFrame,
    season: Sequence[str] = ("season_id",),
    date: str = "match_date",
    gap_days: int = 3,
    least_matches: int = 8,
    name: str = "matchday",
    dates: DataFrame | None = None,
) -> DataFrame:
    """Round numbers from dates: a new round starts after a gap of more than ``gap_days`` days once the current
    round has ``least_matches`` matches. Matches without a date get round 1.

    The fold runs over one (date, count) pair per calendar date of a season, so the array that is collected is
    bounded by the length of the calendar and not by the number of matches. ``dates`` are the same matches before costly columns
    were added, if there are any: the rounds are found from them.
    """
    per_date = (matches if dates is None else dates).filter(F.col(date).isNotNull()).groupBy(*season, date).agg(F.count(F.lit(1)).alias("_n"))
    days = per_date.groupBy(*season).agg(F.array_sort(F.collect_list(F.struct(date, "_n"))).alias("_days"))

    start = F.struct(
        F.lit(1).alias("round"),
        F.lit(0).cast("long").alias("played"),
        F.lit(None).cast("date").alias("last"),
        F.array().cast(f"array<struct<{date}:date,{name}:int>>").alias("rounds"),
    )

    def step(state: Column, day: Column) -> Column:
        starts = (
            state["last"].isNotNull()
            & (F.datediff(day[date], state["last"]) > gap_days)
            & (state["played"] >= least_matches)
        )
        number = state["round"] + F.when(starts, 1).otherwise(0)
        return F.struct(
            number.alias("round"),
            (F.when(starts, F.lit(0).cast("long")).otherwise(state["played"]) + day["_n"]).alias("played"),
            day[date].alias("last"),
            F.concat(state["rounds"], F.array(F.struct(day[date].alias(date), number.alias(name)))).alias("rounds"),
        )

    rounds = days.select(*season, F.explode(F.aggregate("_days", start, step)["rounds"]).alias("_r")).select(
        *season, f"_r.{date}", f"_r.{name}"
    )
    return matches.drop(name).join(rounds, [*season, date], "left").withColumn(name, F.coalesce(name, F.lit(1)))


def pivot_race(race: DataFrame, teams: Sequence[str] | None = None, order: str = "matchday") -> DataFrame:
    """One row per matchday, one column per team: all that are found (which takes a job), or those named."""
    return race.groupBy(order).pivot("team_name", None if teams is None else list(teams)).agg(F.max("cumulative_points"))


def race_by_period(race: DataFrame, order: str = "matchday") -> DataFrame:
    """One row per matchday with all its teams and their totals, whatever teams there are: two lists in the order of the teams'
    names. Unlike a pivot this needs no job to find the teams, and its columns do not depend on the data."""
    cells = F.array_sort(F.collect_list(F.struct("team_name", "cumulative_points")))
    wide = race.groupBy(order).agg(F.count(F.lit(1)).alias("n_teams"), cells.alias("_cells"))
    return wide.select(order, "n_teams", F.col("_cells.team_name").alias("teams"), F.col("_cells.cumulative_points").alias("points"))


def leaders(race: DataFrame, n: int = 6) -> DataFrame:
    """The top ``n`` teams at the last matchday."""
    last = race.agg(F.max("matchday")).scalar()
    return race.filter(F.col("matchday") == last).orderBy(F.desc("cumulative_points"), "team_name").limit(n)


def by_local_date(
    matches: DataFrame,
    time: str = "utc_date",
    zone_id: str = "America/New_York",
    tie_break: Sequence[str] = ("match_id",),
) -> DataFrame:
    """Matches with their calendar date at a place and their place in that day's order.

    Rows stay flat: a busy date is numbered in ranges rather than collected into one array.
    """
    dated = matches.withColumn("local_date", C.local_date(time, zone_id))
    return OrderedRows(dated, [time, *tie_break], ["local_date"]).number("place").result()


def league_totals(table: DataFrame) -> DataFrame:
    """Goals, matches, goals per match, leader, best attack, best defence and most wins in one row.

    Ties go to the better position.
    """

    def best(value: Column) -> Column:
        return F.max_by("team_name", F.struct(value, -F.col("position")))

    goals, matches = F.sum("goals_for"), F.sum("played") / 2
    return table.agg(
        goals.alias("total_goals"),
        matches.alias("total_matches"),
        C.round_to(C.safe_divide(goals, matches), 2).alias("goals_per_match"),
        F.min_by("team_name", "position").alias("leader"),
        best(F.col("goals_for")).alias("best_attack"),
        best(-F.col("goals_against")).alias("best_defence"),
        best(F.col("won")).alias("most_wins"),
    )


def profiles(table: DataFrame) -> DataFrame:
    """Team measures as percent of the league's highest value; defence as 100 - 10 x goals conceded per game."""
    measures = ["goals_for", "won", "points", "win_rate", "goals_per_game"]
    best = table.agg(F.struct(*[F.greatest(F.max(m), F.lit(1)).cast("double").alias(m) for m in measures])).scalar()
    return (
        table.withColumn("_best", best)
        .select(
            "team_name",
            *[
                C.round_to(C.safe_divide(m, F.col(f"_best.{m}")) * 100, 0).alias(f"{m}_score")
                for m in measures
            ],
            C.round_to((100 - F.col("goals_conceded_per_game") * 10) / 100 * 100, 0).alias("defence_score"),
        )
    )
