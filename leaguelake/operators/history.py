"""Latest state, first-seen history and collapsed versions of slowly changing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.functions import columns as C
from leaguelake.operators.ordered import OrderedRows, order_key, row_number_per, sort_columns


def top_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key.

    Spark turns the rank filter into a window group limit that keeps ``n`` rows per key before the shuffle, so a hot
    key costs no more than ``n`` rows per map task.
    """
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order_by))
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("-ingested_at",)) -> DataFrame:
    """One row per key: the first in ``order_by``. Filter before calling; a filter does not pass a window."""
    return top_per_key(df, keys, order_by)


def distinct_on(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], where: Column | None = None) -> DataFrame:
    """Filter, then keep one row per key."""
    return top_per_key(df if where is None else df.filter(where), keys, order_by)


def drop_repeated(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key; with ``order_by`` the choice is fixed, without it any row may stay."""
    return top_per_key(df, keys, order_by) if order_by else df.dropDuplicates(list(keys))


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*names).distinct()


def scd1(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    seen_at: str = "ingested_at",
) -> DataFrame:
    """Latest state per key with first and last time seen, number of versions and a correction flag.

    The state is a group limit, which sends one row per key and map task; the history is a hash aggregate of one narrow
    column. Both end partitioned by the key, so that joining them moves nothing. A key is one struct: structs compare
    NULL fields as equal.
    """
    key = F.struct(*keys).alias("_key")
    state = top_per_key(df.select(key, *df.columns), ["_key"], order_by).drop(seen_at)
    history = df.groupBy(key).agg(
        F.min(seen_at).alias("first_seen_at"), F.max(seen_at).alias("last_updated_at"), F.count(F.lit(1)).alias("update_count")
    )
    out = state.join(history, "_key").drop("_key")
    return out.withColumn("is_correction", F.col("update_count") > 1)


def change_islands(
    df: DataFrame, entity: Sequence[str], order_by: Sequence[str], tracked: str, name: str = "version_group"
) -> DataFrame:
    """Number runs of equal ``tracked`` values; a run starts where the value differs from the row before,
    NULL being a value like others."""
    same = (F.col("_at") > 1) & F.col("_previous").eqNullSafe(F.col(tracked))
    return (
        OrderedRows(df, order_by, entity)
        .number("_at")
        .previous(_previous=tracked)
        .derive(_changed=C.flag(~same))
        .running(**{name: ("sum", "_changed")})
        .result()
        .drop("_changed", "_previous", "_at")
    )


def period_totals(
    results: DataFrame,
    entity: str = "team_name",
    period: str = "matchday",
    sums: Mapping[str, str] | None = None,
    date: str = "match_date",
) -> DataFrame:
    """Totals up to and including each observed period.

    Rows are first summed to one row per entity and period (map-side combined), so the window over an entity sees
    its periods only, not its rows.
    """
    sums = sums or {"points": "pts", "goals_for": "gf", "goals_against": "ga"}
    per_period = results.groupBy(entity, period).agg(
        *[F.sum(c).alias(name) for name, c in sums.items()],
        F.count(F.lit(1)).alias("played"),
        F.max(date).alias("matchday_date"),
    )
    so_far = (
        Window.partitionBy(entity).orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return per_period.select(
        entity,
        period,
        *[F.sum(c).over(so_far).alias(c) for c in [*sums, "played"]],
        F.max("matchday_date").over(so_far).alias("matchday_date"),
    )


def scd2(
    results: DataFrame,
    entity: str = "team_name",
    period: str = "matchday",
    stats: str = "last",
) -> DataFrame:
    """Position history: one row per run of periods at the same position.

    ``stats="last"`` reports the totals at the end of a version, ``stats="max"`` their highest values in it (the
    two differ for the goal difference only, which can fall).
    """
    totals = period_totals(results, entity, period).withColumn(
        "goal_difference", F.col("goals_for") - F.col("goals_against")
    )
    ranked = row_number_per(
        totals,
        [period],
        ["-points", "-goal_difference", "-goals_for", entity],
        "position",
        whole=True,
    )
    # From here on a group is one entity with at most one row per period.
    by_period = Window.partitionBy(entity).orderBy(period)
    so_far = by_period.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("position").over(by_period)
    versioned = ranked.withColumn(
        "_changed", C.flag(before.isNull() | (before != F.col("position")))
    ).withColumn("version_group", F.sum("_changed").over(so_far))

    measures = ["points", "played", "goals_for", "goals_against", "goal_difference"]
    at_end = [(F.max(m) if stats == "max" else F.max_by(m, period)).alias(m) for m in measures]
    versions = versioned.groupBy(entity, "position", "version_group").agg(
        F.min(period).alias("valid_from_matchday"),
        F.max(period).alias("valid_to_matchday"),
        F.min("matchday_date").alias("valid_from_date"),
        F.max("matchday_date").alias("valid_to_date"),
        *at_end,
        (F.max(period) - F.min(period) + 1).alias("matchdays_held"),
    )
    by_version = Window.partitionBy(entity).orderBy("valid_from_matchday")
    last = F.max("valid_to_matchday").over(Window.partitionBy(entity))
    previous, position = F.col("prev_position"), F.col("position")
    return (
        versions.withColumn("prev_position", F.lag("position").over(by_version))
        .withColumn(
            "movement",
            C.choose(
                (previous.isNull(), "NEW"), (position < previous, "UP"), (position > previous, "DOWN"), default="SAME"
            ),
        )
        .withColumn("is_current", F.coalesce(F.col("valid_to_matchday") == last, F.lit(False)))
        .drop("version_group")
    )


def versions_at(versions: DataFrame, period: int) -> DataFrame:
    """Versions valid in one period."""
    return versions.filter(F.lit(period).between(F.col("valid_from_matchday"), F.col("valid_to_matchday")))


def as_of_versions(
    points: DataFrame, versions: DataFrame, entity: str = "team_name", period: str = "matchday"
) -> DataFrame:
    """For each (entity, period) row the version that is valid then; rows outside all versions are kept.

    The versions of an entity must not overlap. Each version is one row at its start, sorted among the entity's points;
    a point takes the last start up to its period and keeps it if that version has not ended. No row is added per
    period, there is no range condition, and a large entity is cut into ranges.
    """
    first, last = "valid_from_matchday", "valid_to_matchday"
    rest = [c for c in versions.columns if c not in (entity, period)]
    version = F.struct(first, *(c for c in rest if c != first))
    starts = versions.filter(F.col(first) <= F.col(last)).select(
        F.col(entity).alias("_entity"), F.col(first).alias("_at"), F.lit(0).alias("_point"), version.alias("_version")
    )
    asked = points.select(
        F.col(entity).alias("_entity"), F.col(period).alias("_at"), F.lit(1).alias("_point"), F.struct("*").alias("_row")
    )
    both = asked.unionByName(starts, allowMissingColumns=True)
    found = OrderedRows(both, ["_at", "_point"], ["_entity"]).running(_found=("last", "_version")).result()
    valid = F.col("_entity").isNotNull() & (F.col("_at") <= F.col(f"_found.{last}"))
    values = [F.when(valid, F.col(f"_found.{c}")).alias(c) for c in rest]
    return found.filter("_point = 1").select("_row.*", *values)


def biggest_movers(versions: DataFrame, entity: str = "team_name") -> DataFrame:
    """Start and current position, change, points and number of versions per entity."""
    start = F.min_by("position", "valid_from_matchday")
    current = F.max_by("position", "valid_from_matchday")
    return versions.groupBy(entity).agg(
        current.alias("current_position"),
        start.alias("start_position"),
        (start - current).alias("change"),
        F.max_by("points", "valid_from_matchday").alias("points"),
        F.count(F.lit(1)).alias("versions"),
    )
