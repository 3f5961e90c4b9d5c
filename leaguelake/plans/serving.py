"""Parameterised result sets. A filter or limit that is not given changes nothing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leaguelake.operators.history import versions_at
from leaguelake.operators.ordered import sort_columns
from leaguelake.sources.exports import date_window
from leaguelake.sources.landing import first_available


def same_name(column: str, name: str) -> Column:
    return F.lower(F.col(column)) == name.lower()


def top(df: DataFrame, order_by: Sequence[str], limit: int | None = None) -> DataFrame:
    """The rows in order: the first ``limit`` of them, or all."""
    rows = df.orderBy(*sort_columns(order_by))
    return rows if limit is None else rows.limit(max(limit, 0))


def league_table(live: DataFrame, batch: DataFrame) -> DataFrame:
    """The live table, or the batch table while the live one is empty; columns that both have."""
    shared = [c for c in live.columns if c in batch.columns]
    return first_available(("live", live.select(*shared)), ("batch", batch.select(*shared)))


def standings_history(
    versions: DataFrame, team: str | None = None, matchday: int | None = None, current_only: bool = False
) -> DataFrame:
    out = versions
    if team:
        out = out.filter(same_name("team_name", team))
    if matchday is not None:
        out = versions_at(out, matchday)
    return out.filter("is_current") if current_only else out


def race(
    points: DataFrame, teams: Sequence[str] = (), first: int | None = None, last: int | None = None
) -> DataFrame:
    out = points
    if teams:
        out = out.filter(F.lower("team_name").isin(*[t.strip().lower() for t in teams]))
    if first is not None:
        out = out.filter(F.col("matchday") >= first)
    if last is not None:
        out = out.filter(F.col("matchday") <= last)
    return out


def form(rows: DataFrame, team: str | None = None, momentum: str | None = None) -> DataFrame:
    out = rows
    if team:
        out = out.filter(same_name("team_name", team))
    return out.filter(F.col("current_momentum") == momentum.upper()) if momentum else out


def teams(dim: DataFrame, tier: str | None = None, team: str | None = None) -> DataFrame:
    out = dim
    if tier:
        out = out.filter(F.col("tier") == tier.upper())
    return out.filter(same_name("team_name", team)) if team else out


def matches(results: DataFrame, limit: int | None = None) -> DataFrame:
    return top(results, ["matchday", "match_date", "match_id"], limit)


def results(rows: DataFrame, limit: int | None = None) -> DataFrame:
    return top(rows, ["-match_date", "-matchday", "match_id"], limit)


def scorers(rows: DataFrame, limit: int | None = None) -> DataFrame:
    return top(rows, ["rank"], limit)


def live_window(live: DataFrame, as_of: Column) -> DataFrame:
    """Matches around the as-of date, newest first."""
    return date_window(live, "utc_date", as_of).orderBy(F.col("utc_date").desc_nulls_last(), "match_id")


def results_by_round(rows: DataFrame, matchday: int | None = None) -> DataFrame:
    """All rounds, newest first, or one of them."""
    out = rows if matchday is None else rows.filter(F.col("matchday") == matchday)
    return out.orderBy(F.col("matchday").desc_nulls_last(), "match_id")
