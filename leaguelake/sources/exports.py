"""Exports: JSON records, files per key, nested entity documents and the replay bundle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguelake.functions import columns as C
from leaguelake.operators.events import REPLAY_ORDER, replay_events, replay_index
from leaguelake.operators.ordered import row_number_per, sort_columns

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSS"
JSON_OPTIONS = {"timestampFormat": ISO, "timestampNTZFormat": ISO, "ignoreNullFields": "false"}


def sanitize_nonfinite(df: DataFrame) -> DataFrame:
    """NaN and infinities become NULL in every float and double column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, T.FloatType | T.DoubleType)]
    return df.withColumns({c: C.finite(c) for c in floats}) if floats else df


def ordered_records(df: DataFrame, order_by: Sequence[str], limit: int | None = None) -> DataFrame:
    """Cleaned rows in order; with a limit Spark keeps the top rows of each task only."""
    out = sanitize_nonfinite(df).orderBy(*sort_columns(order_by))
    return out if limit is None else out.limit(limit)


def export_records(df: DataFrame, path: str, order_by: Sequence[str], limit: int | None = None) -> None:
    """Ordered JSON lines with ISO times; null fields are written."""
    ordered_records(df, order_by, limit).write.mode("overwrite").options(**JSON_OPTIONS).json(path)


def export_per_key(df: DataFrame, path: str, key: str, order_by: Sequence[str]) -> None:
    """One folder per key, rows in order over its files.

    Rows are range-partitioned by key and order, so a very large key is written by several tasks.
    """
    order = [F.col(key).asc_nulls_first(), *sort_columns(order_by)]
    (
        sanitize_nonfinite(df)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode("overwrite")
        .partitionBy(key)
        .options(**JSON_OPTIONS)
        .json(path)
    )


def date_window(df: DataFrame, time: str, as_of: Column, before: int = 1, after: int = 3) -> DataFrame:
    """Rows from ``before`` days before the as-of date to ``after`` days after it."""
    low, high = F.date_sub(as_of, before), F.date_add(as_of, after)
    kind = df.schema[time].dataType
    return df.filter(F.col(time).between(low.cast(kind), high.cast(kind)))


LIVE_STANDINGS = [
    "position",
    "team_name",
    "played",
    "won",
    "drawn",
    "lost",
    "points",
    "goals_for",
    "goals_against",
    "goal_difference",
    "win_rate",
    "points_pct",
    "goals_per_game",
    "goals_conceded_per_game",
    "qualification_zone",
    "form",
]


def live_standings(table: DataFrame) -> DataFrame:
    return table.select(*LIVE_STANDINGS).orderBy("position")


def season_matches(matches: DataFrame, *season_ids: int, time: str = "match_date") -> DataFrame:
    return matches.filter(F.col("season_id").isin(*season_ids)).orderBy(F.col(time).desc_nulls_last(), "match_id")


def parts(
    df: DataFrame,
    key: str,
    order_by: Sequence[str],
    name: str,
    per_part: int,
) -> DataFrame:
    """Ordered rows of each key as arrays of at most ``per_part`` structs, numbered from 0 in ``part``."""
    fields = [c for c in df.columns if c != key]
    numbered = row_number_per(df, [key], order_by, "_n")
    rows = F.array_sort(F.collect_list(F.struct("_n", F.struct(*fields).alias("row"))))
    return (
        numbered.withColumn("part", F.floor((F.col("_n") - 1) / per_part))
        .groupBy(key, "part")
        .agg(F.transform(rows, lambda r: r["row"]).alias(name))
    )


def entity_documents(
    table: DataFrame,
    lists: Mapping[str, tuple[DataFrame, Sequence[str]]],
    key: str = "team_id",
    per_part: int = 1000,
) -> DataFrame:
    """One nested document per entity: its table row and ordered lists, e.g. ``matches`` and ``scorers``.

    An entity with more than ``per_part`` rows in a list gets further parts; part 0 alone carries the table row.
    A usual season fits into part 0.
    """
    keys = table.select(key, F.lit(0).cast("long").alias("part"), F.struct("*").alias("standings"))
    out = keys
    for name, (df, order_by) in lists.items():
        out = out.join(parts(df, key, order_by, name, per_part), [key, "part"], "full")
    empty = [F.coalesce(F.col(n), F.array()).alias(n) for n in lists]
    return out.select(key, "part", "standings", *empty).join(table.select(key), key, "left_semi")


def replay_bundle(events: DataFrame, matches: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Index of the ``n`` matches with most events, and their events in replay order."""
    index = replay_index(events, matches, n)
    return index, replay_events(events, index)


def export_replay(events: DataFrame, matches: DataFrame, path: str, n: int = 10) -> None:
    """Write the index and one folder of ordered events per match."""
    index, rows = replay_bundle(events, matches, n)
    export_records(index, f"{path}/_index.json", ["-event_count", "match_id"])
    export_per_key(rows, f"{path}/events", "match_id", REPLAY_ORDER)
