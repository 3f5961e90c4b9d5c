"""Joins: enrichment of a large table with hot keys, presence and absence of keys, counts per side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64
HOT_SHARE = 0.002


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE) -> DataFrame:
    """One row with the array of keys that hold more than ``share`` of the rows, from one pass.

    A frequent-items sketch counts keys within each task and merges the tasks' sketches: keys above the share are in it, and no
    key is shuffled. NULL is no key; without keys the array is empty.
    """
    most = int(1 / share)
    return df.agg(
        F.expr(f"approx_top_k({key}, {most}, {16 * most})").alias("top"), F.count(F.lit(1)).alias("total"), F.count(key).alias("known")
    ).select(
        F.when(F.col("known") == 0, F.array().cast(f"array<{dict(df.dtypes)[key]}>"))
        .otherwise(F.transform(F.filter("top", lambda x: x["item"].isNotNull() & (x["count"] > F.col("total") * share)), lambda x: x["item"]))
        .alias("hot")
    )


def broadcast_by_size(dim: DataFrame) -> bool:
    """Whether Spark's estimate of a table's size lets it broadcast the table."""
    conf = dim.sparkSession._jsparkSession.sessionState().conf()
    return 0 <= dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= conf.autoBroadcastJoinThreshold()


def enrich(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: Sequence[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join a table with one row per key to a large table in which some keys may hold most of the rows.

    Where Spark's size estimate of the dimension lets it broadcast, this is a plain join and the fact is read once. Otherwise rows of hot
    keys are spread over ``salts`` buckets by a hash of ``spread_by`` (a row's own values, so a retried task puts it in the
    same bucket) and only the hot dimension rows are repeated. Which keys are hot changes the layout, never the
    result. Rows without a key match nothing and are spread too.
    """
    if broadcast_by_size(dim):
        return fact.join(dim, key, how)
    hot = hot_keys(fact, key)
    is_hot = F.coalesce(F.array_contains(F.col("_hot"), F.col(key)), F.lit(False))
    spread = is_hot | F.col(key).isNull()
    salted_fact = (
        fact.withColumn("_hot", hot.scalar())
        .withColumn(
            "_salt",
            F.when(spread, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")).otherwise(F.lit(0)),
        )
        .drop("_hot")
    )
    salted_dim = (
        dim.withColumn("_hot", hot.scalar())
        .withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, F.lit(salts - 1)).otherwise(F.lit(0))))
        )
        .drop("_hot")
    )
    return salted_fact.join(salted_dim, [key, "_salt"], how).drop("_salt")


def present(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``keys``."""
    return df.join(keys.select(*on), list(on), "left_semi")


def absent(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is known and does not occur in ``keys``."""
    known: Column = F.lit(True)
    for c in on:
        known = known & F.col(c).isNotNull()
    return df.filter(known).join(keys.select(*on), list(on), "left_anti")


def with_side_counts(table: DataFrame, sides: DataFrame, key: str = "team_id") -> DataFrame:
    """Wins and matches per entity over both sides, 0 for entities without matches.

    Counts come from one aggregate over the unpivoted sides; an OR over the two side columns would be planned as a
    nested loop.
    """
    counts = sides.groupBy(key).agg(
        F.count_if(F.col("result") == "W").alias("total_wins"), F.count(F.lit(1)).alias("total_matches")
    )
    zero = F.lit(0).cast("long")
    return table.join(counts, key, "left").withColumns(
        {c: F.coalesce(F.col(c), zero) for c in ("total_wins", "total_matches")}
    )
