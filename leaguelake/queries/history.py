"""Latest state, versions and lookups in time."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaguelake.operators import history
from leaguelake.operators.ordered import OrderedRows
from leaguelake.plans import marts
from leaguelake.plans.adapters import NEWEST, cte, load, table
from leaguelake.queries.league import finished
from leaguelake.queries.registry import (
    LIVE_COLUMNS,
    LIVE_SIDES,
    PRIMARY,
    newest,
    query,
    versions,
    with_ctes,
)

LIVE = cte("live_matches")


@query(with_ctes(LIVE, select=f"SELECT * FROM {newest('live_matches', 'match_id')}"))
def latest_per_key(spark, sf_dir):
    return history.latest_per_key(load(spark, sf_dir, "live_matches"), ["match_id"], NEWEST)


@query(
    with_ctes(
        LIVE, select=f"SELECT * FROM {newest('live_matches', 'match_id', PRIMARY + ' AND home_score IS NOT NULL')}"
    )
)
def distinct_on(spark, sf_dir):
    wanted = (F.col("source") == "football-data.org") & F.col("home_score").isNotNull()
    return history.distinct_on(load(spark, sf_dir, "live_matches"), ["match_id"], NEWEST, wanted)


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def drop_repeated(spark, sf_dir):
    return history.drop_repeated(table(spark, sf_dir, "events"), ["user_id", "event_type"], ["event_id"])


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_shipdate FROM lineitem")
def distinct_values(spark, sf_dir):
    return history.distinct_values(table(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", "l_shipdate")


@query(
    with_ctes(
        LIVE,
        f"""state AS (SELECT {LIVE_COLUMNS} FROM {newest('live_matches', 'match_id', PRIMARY)})""",
        f"""seen AS (SELECT match_id, min(ingested_at) AS first_seen_at, max(ingested_at) AS last_updated_at,
 count(*) AS update_count FROM live_matches WHERE {PRIMARY} GROUP BY match_id)""",
        select="""SELECT s.* EXCLUDE (home_team_raw, away_team_raw, matchday_approx), matchday_approx AS matchday,
 first_seen_at, last_updated_at, update_count, update_count > 1 AS is_correction
 FROM state s JOIN seen USING (match_id)""",
    )
)
def scd1_matches(spark, sf_dir):
    return marts.scd1_matches(load(spark, sf_dir, "live_matches"), order_by=NEWEST)


@query(with_ctes(*versions(), select="SELECT * FROM versions"))
def scd2_standings(spark, sf_dir):
    return marts.scd2_standings(finished(spark, sf_dir))


@query(with_ctes(*versions("max"), select="SELECT * FROM versions"))
def scd2_standings_highest_stats(spark, sf_dir):
    return marts.scd2_standings(finished(spark, sf_dir), stats="max")


@query(
    with_ctes(
        *LIVE_SIDES,
        """per_matchday AS (SELECT team_name, matchday, sum(pts) AS p, sum(gf) AS f, sum(ga) AS a, count(*) AS n,
 max(match_date) AS d FROM live_sides GROUP BY team_name, matchday)""",
        select="""SELECT team_name, matchday, CAST(sum(p) OVER w AS BIGINT) AS points,
 CAST(sum(f) OVER w AS BIGINT) AS goals_for, CAST(sum(a) OVER w AS BIGINT) AS goals_against,
 CAST(sum(n) OVER w AS BIGINT) AS played, max(d) OVER w AS matchday_date FROM per_matchday
 WINDOW w AS (PARTITION BY team_name ORDER BY matchday)""",
    )
)
def period_totals(spark, sf_dir):
    return history.period_totals(marts.live_sides(finished(spark, sf_dir), "matchday", "match_date"))


@query(
    """SELECT event_id, user_id, kind AS event_type, CAST(sum(changed) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS version_group
 FROM (SELECT *, CASE WHEN row_number() OVER w > 1 AND lag(kind) OVER w IS NOT DISTINCT FROM kind THEN 0 ELSE 1 END AS changed
 FROM (SELECT *, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS kind FROM events)
 WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""
)
def change_islands(spark, sf_dir):
    """With NULLs planted among the tracked values."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    rows = rows.withColumn("event_type", F.when(F.col("event_id") % 3 != 0, F.col("event_type")))
    return history.change_islands(rows, ["user_id"], ["ts", "event_id"], "event_type").drop("ts")


@query(
    """SELECT event_id, user_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous_type
 FROM events"""
)
def previous_row(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return (
        OrderedRows(rows, ["ts", "event_id"], ["user_id"])
        .previous(previous_type="event_type")
        .result()
        .drop("event_type", "ts")
    )


@query(
    with_ctes(
        *versions(),
        select="""SELECT s.match_id, s.team_name, s.matchday, v.position, v.valid_from_matchday FROM live_sides s
 LEFT JOIN versions v ON v.team_name = s.team_name AND s.matchday BETWEEN v.valid_from_matchday
 AND v.valid_to_matchday""",
    )
)
def as_of_versions(spark, sf_dir):
    """For every team and match the table position that was valid on its matchday."""
    results = finished(spark, sf_dir)
    rows = marts.live_sides(results, "match_id", "matchday").select("match_id", "team_name", "matchday")
    valid = marts.scd2_standings(results).select(
        "team_name", "position", "valid_from_matchday", "valid_to_matchday"
    )
    return history.as_of_versions(rows, valid).drop("valid_to_matchday")


@query(
    with_ctes(
        *versions(),
        select="""SELECT team_name, arg_max(position, valid_from_matchday) AS current_position,
 arg_min(position, valid_from_matchday) AS start_position,
 arg_min(position, valid_from_matchday) - arg_max(position, valid_from_matchday) AS change,
 arg_max(points, valid_from_matchday) AS points, count(*) AS versions FROM versions GROUP BY team_name""",
    )
)
def biggest_movers(spark, sf_dir):
    return history.biggest_movers(marts.scd2_standings(finished(spark, sf_dir)))
