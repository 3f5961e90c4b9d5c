"""End-to-end jobs: land a feed, build the live gold tables, build the batch gold tables.

A lake is a folder with ``bronze`` (append-only), ``gold`` (rebuilt) and ``quarantine``. Jobs are plain functions; any
scheduler can call them, and a repeated call rebuilds the same gold tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.operators import events as match_events
from leaguelake.operators import quality, results
from leaguelake.plans import marts
from leaguelake.plans.graph import PART, VIEW, Node, materialised
from leaguelake.session import stored
from leaguelake.sources import exports, feeds, landing

# Versions ingested at the same time are told apart by their text.
NEWEST = ("-ingested_at", "raw_json")


def bronze(spark: SparkSession, lake: str, table: str) -> DataFrame:
    return landing.read_merged(spark, f"{lake}/bronze/{table}")


def write_gold(lake: str, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{lake}/gold/{name}")


def land_matches(
    spark: SparkSession,
    payloads: str,
    lake: str,
    fallback_payloads: str | None = None,
    at: Column | None = None,
    block: bool = False,
) -> DataFrame:
    """Land match payloads, or those of the fallback feed if there are none.

    All records are appended to bronze, with the verdict of the contract and its violations; what reads bronze decides. Records of the
    primary feed that break the contract are copied to quarantine too. With ``block`` nothing is appended if too many
    do. Returns the one-row contract gate.
    """

    def primary() -> DataFrame:
        return feeds.normalize_match_feed(feeds.read_payloads(spark, payloads))

    def fallback() -> DataFrame:
        return feeds.normalize_fallback_feed(feeds.read_payloads(spark, fallback_payloads or ""))

    chosen = landing.first_available((values.PRIMARY_SOURCE, primary), (values.FALLBACK_SOURCE, fallback))
    is_primary = F.col("source") == values.PRIMARY_SOURCE
    rows = stored(quality.judged(chosen.drop("source_used"), values.MATCH_CONTRACT), "matches-feed")
    gate = stored(quality.gate_of(rows.filter(is_primary), values.MATCH_CONTRACT["name"]), "gate")
    landing.append_bronze(rows.filter(is_primary & (F.col("verdict") == "quarantined")).drop("verdict"), f"{lake}/quarantine/live_matches", at)
    log = f"{lake}/bronze/pipeline_runs"
    if block and not gate.first().valid:
        landing.run_log(spark, log, "live_matches", "blocked", "contract", 0)
        return gate
    landed = rows.withColumn("verdict", F.when(is_primary, F.col("verdict"))).drop("violations")
    landing.append_bronze(landed, f"{lake}/bronze/live_matches", at)
    landing.run_log(spark, log, "live_matches", "success", "", landed.count())
    return gate


def land_standings(
    spark: SparkSession, payloads: str, lake: str, at: Column | None = None, computed: Callable[[], DataFrame] | None = None
) -> None:
    """Land standings payloads, or where there are none the standings ``computed`` from results; the run is logged with the source
    that was used."""

    def primary() -> DataFrame:
        return feeds.normalize_standings_feed(feeds.read_payloads(spark, payloads))

    sources = [(values.PRIMARY_SOURCE, primary), *([("computed", computed)] if computed else [])]
    log = f"{lake}/bronze/pipeline_runs"
    try:
        chosen = landing.first_available(*sources)
    except ValueError as e:
        landing.run_log(spark, log, "live_standings", "failed", str(e), 0)
        return
    rows = stored(chosen, "standings-feed")
    landing.append_bronze(rows.drop("source_used"), f"{lake}/bronze/live_standings", at)
    used = rows.agg(F.max("source_used"), F.count(F.lit(1))).first()
    landing.run_log(spark, log, "live_standings", "success" if used[1] else "empty", f"source={used[0]}", used[1])


def closing_gate(spark: SparkSession, lake: str, as_of: Column) -> DataFrame:
    """The live monitor and whether it lets an export pass, one row: fresh within its limit, and no running match without a score."""
    monitor = marts.live_match_monitor(bronze(spark, lake, "live_matches"), as_of, NEWEST)
    return monitor.withColumn("may_export", F.col("freshness_status").startswith("PASS"))


def export_live(spark: SparkSession, lake: str, folder: str, as_of: Column) -> bool:
    """Write the live window, table and monitor as JSON records, if the gate lets them pass; the run is logged either way."""
    gate = stored(closing_gate(spark, lake, as_of), "closing-gate")
    passed = bool(gate.first().may_export)
    log = f"{lake}/bronze/pipeline_runs"
    if passed:
        gold = lambda name: spark.read.parquet(f"{lake}/gold/{name}")
        window = exports.date_window(gold("live_matches"), "utc_date", F.to_date(as_of))
        exports.export_records(window, f"{folder}/live_matches", ["utc_date", "match_id"])
        exports.export_records(exports.live_standings(gold("live_league_table")), f"{folder}/standings", ["position", "team_name"])
        exports.export_records(gate, f"{folder}/monitor", ["freshness_status"])
    landing.run_log(spark, log, "export_live", "success" if passed else "blocked", "" if passed else "freshness", 0)
    return passed


def live_graph(as_of: Column, newest: Sequence[str] = NEWEST) -> dict[str, Node]:
    """The live gold tables over the bronze tables ``versions`` and ``standings``. Finished results and the form are parts: made
    once, read by several tables."""
    return {
        "live_matches": Node(lambda v: marts.live_matches_mart(marts.live_state(v, order_by=newest)), ("versions",)),
        "live_league_table": Node(lambda s: marts.live_league_table(s, order_by=newest), ("standings",)),
        "finished": Node(lambda v: marts.finished_results(v, order_by=newest), ("versions",), PART),
        "points_race": Node(marts.points_race, ("finished",)),
        "rolling_form": Node(marts.form, ("finished",)),
        "scd1_matches": Node(lambda v: marts.scd1_matches(v, order_by=newest), ("versions",)),
        "scd2_standings": Node(marts.scd2_standings, ("finished",)),
        "dim_matchdays": Node(lambda v: marts.dim_matchdays(v, F.to_date(as_of), order_by=newest), ("versions",)),
        "dim_teams": Node(marts.dim_teams, ("live_league_table", "rolling_form")),
        "live_match_monitor": Node(lambda v: marts.live_match_monitor(v, as_of, newest), ("versions",)),
        "race_leaders": Node(results.leaders, ("points_race",), VIEW),
    }


def build_live_gold(spark: SparkSession, lake: str, as_of: Column, newest: Sequence[str] = NEWEST) -> dict[str, DataFrame]:
    """Live state, table, race, form, histories, dimensions and monitor from the landed versions."""
    sources = {"versions": bronze(spark, lake, "live_matches"), "standings": bronze(spark, lake, "live_standings")}
    return materialised(spark, f"{lake}/gold", live_graph(as_of, newest), sources)


def build_batch_gold(spark: SparkSession, lake: str, season_id: int | None = None) -> None:
    """Table, results, form and event statistics of a season; results are appended, the rest is rebuilt."""
    matches = stored(marts.clean_matches(bronze(spark, lake, "matches"), season_id), "clean-matches")
    landing.incremental_append(marts.recent_results(matches), f"{lake}/gold/recent_results", "match_id")
    sides = marts.match_sides(matches, ["match_id", "match_date"])
    tables = {
        "league_table": marts.league_table(matches),
        "team_stats": marts.team_stats(matches),
        "team_form": results.recent_form(sides),
    }
    events = landing.read_or_none(spark, f"{lake}/bronze/events")
    if events is not None:
        context = ["home_team_name", "away_team_name", "home_score", "away_score", "match_date"]
        tables |= {
            "match_events": match_events.match_context(events, matches, context),
            "player_stats": match_events.player_match_stats(events),
            "top_scorers": match_events.scorers(events),
        }
    write_gold(lake, tables)
