"""Match event statistics and the replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaguelake.operators import events as E
from leaguelake.operators.joins import absent, enrich, present
from leaguelake.plans.adapters import cte, load, table
from leaguelake.queries.league import sides
from leaguelake.queries.registry import ASSIST, CLEAN, EVENTS, GOAL, SIDES, query, with_ctes
from leaguelake.sources.landing import sample_keys


def events(spark, sf_dir):
    return load(spark, sf_dir, "match_events")


def matches(spark, sf_dir):
    return load(spark, sf_dir, "matches")


def one(condition: str) -> str:
    return f"count(CASE WHEN {condition} THEN 1 END)"


@query(
    with_ctes(
        *EVENTS,
        select=f"""SELECT player_id, player_name, team_id, team_name, {one(GOAL)} AS goals, {one(ASSIST)} AS assists
 FROM match_events WHERE player_id IS NOT NULL GROUP BY ALL HAVING {one(GOAL)} > 0""",
    )
)
def goals_and_assists(spark, sf_dir):
    return E.goals_and_assists(events(spark, sf_dir))


@query(
    with_ctes(
        *EVENTS,
        select="""SELECT match_id, player_id, player_name, team_id, team_name, count(DISTINCT event_id) AS event_count
 FROM match_events WHERE player_id IS NOT NULL GROUP BY ALL""",
    )
)
def player_match_stats(spark, sf_dir):
    return E.player_match_stats(events(spark, sf_dir))


@query(
    with_ctes(
        *EVENTS,
        f"""s AS (SELECT player_id, player_name, team_name, {one(GOAL)} AS goals,
 count(DISTINCT match_id) AS matches_played FROM match_events WHERE player_id IS NOT NULL GROUP BY ALL)""",
        f"a AS (SELECT player_id, count(*) AS n FROM match_events WHERE {ASSIST} GROUP BY player_id)",
        select="""SELECT s.player_id, player_name, team_name, goals, coalesce(n, 0) AS assists,
 goals + coalesce(n, 0) AS goal_contributions, matches_played,
 round(CAST(goals AS DOUBLE) / matches_played, 2) AS goals_per_game,
 row_number() OVER (ORDER BY goals DESC, coalesce(n, 0) DESC, s.player_id, player_name, team_name) AS rank
 FROM s LEFT JOIN a ON s.player_id = a.player_id WHERE goals > 0""",
    )
)
def event_scorers(spark, sf_dir):
    return E.scorers(events(spark, sf_dir))


@query(
    with_ctes(
        *EVENTS,
        select=f"""SELECT match_id, team_name, {one("event_type = 'Shot'")} AS shots, {one("event_type = 'Pass'")} AS passes,
 {one(GOAL)} AS goals,
 {one("event_type IN ('Shot', 'Goal', 'Card', 'Substitution', 'Foul Committed')")} AS key_events
 FROM match_events GROUP BY ALL""",
    )
)
def match_stats(spark, sf_dir):
    return E.match_stats(events(spark, sf_dir))


@query(
    with_ctes(
        *EVENTS,
        select="""SELECT event_id, match_id, event_type, outcome FROM match_events
 WHERE event_type IN ('Shot', 'Goal', 'Card', 'Substitution', 'Foul Committed')""",
    )
)
def key_events(spark, sf_dir):
    return E.key_events(events(spark, sf_dir)).select("event_id", "match_id", "event_type", "outcome")


CONTEXT = ["home_team_name", "away_team_name", "home_score", "away_score", "match_date"]


@query(
    with_ctes(
        *EVENTS,
        *CLEAN,
        select=f"""SELECT e.*, {', '.join('m.' + c for c in CONTEXT)} FROM match_events e
 JOIN clean m ON e.match_id = m.match_id""",
    )
)
def match_events(spark, sf_dir):
    available = matches(spark, sf_dir).filter("match_status = 'available'")
    return E.match_context(events(spark, sf_dir), available, CONTEXT)


@query(
    """SELECT l_orderkey, l_partkey, l_linenumber, l_shipdate, p_brand, p_retailprice FROM lineitem
 LEFT JOIN part ON l_partkey = p_partkey"""
)
def enrich_left(spark, sf_dir):
    part = table(spark, sf_dir, "part").selectExpr("p_partkey AS l_partkey", "p_brand", "p_retailprice")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")
    return enrich(lines, part, "l_partkey", ["l_orderkey", "l_linenumber"], "left")


@query("SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def absent_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").selectExpr("o_custkey AS c_custkey")
    return absent(table(spark, sf_dir, "customer"), orders, ["c_custkey"])


@query("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def present_keys(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").filter("o_totalprice > 400000").selectExpr("o_custkey AS c_custkey")
    return present(table(spark, sf_dir, "customer"), orders, ["c_custkey"])


@query(
    with_ctes(
        *EVENTS,
        select="""SELECT * FROM match_events WHERE match_id IN (SELECT DISTINCT match_id FROM match_events
 ORDER BY match_id LIMIT 50)""",
    )
)
def first_matches_sample(spark, sf_dir):
    return sample_keys(events(spark, sf_dir), "match_id", 50)


INDEX = """replay_index AS (SELECT e.match_id, count(*) AS event_count, home_team_name, away_team_name, home_score,
 away_score FROM match_events e JOIN matches m ON e.match_id = m.match_id GROUP BY ALL
 ORDER BY event_count DESC, e.match_id LIMIT 10)"""


@query(with_ctes(*EVENTS, cte("matches"), INDEX, select="SELECT * FROM replay_index"))
def replay_index(spark, sf_dir):
    return E.replay_index(events(spark, sf_dir), matches(spark, sf_dir))


@query(
    with_ctes(
        *EVENTS,
        cte("matches"),
        INDEX,
        select="""SELECT event_id, match_id, period, minute, second, event_type, team_name, row_number() OVER (
 PARTITION BY match_id ORDER BY period, minute, second, index_num) AS index FROM match_events
 WHERE match_id IN (SELECT match_id FROM replay_index)""",
    )
)
def replay_events(spark, sf_dir):
    index = E.replay_index(events(spark, sf_dir), matches(spark, sf_dir))
    return E.replay_events(events(spark, sf_dir), index).select(
        "event_id", "match_id", "period", "minute", "second", "event_type", "team_name", "index"
    )



def schedule_sql(match: str) -> str:
    return with_ctes(
        *EVENTS,
        f"timed AS (SELECT * REPLACE ({match} AS match_id) FROM match_events)",
        select="""SELECT event_id, match_id, index, total, delay_seconds, CAST(sum(delay_seconds) OVER (PARTITION BY match_id
 ORDER BY index) AS DOUBLE) * 1000 / 10 AS emit_ms FROM (SELECT event_id, match_id, row_number() OVER w AS index,
 count(*) OVER (PARTITION BY match_id) AS total,
 greatest(0, minute * 60 + second - coalesce(lag(minute * 60 + second) OVER w, 0)) AS delay_seconds FROM timed
 WINDOW w AS (PARTITION BY match_id ORDER BY period, minute, second, index_num))""",
    )


SCHEDULE_COLUMNS = ["event_id", "match_id", "index", "total", "delay_seconds", "emit_ms"]


@query(schedule_sql("match_id"))
def replay_schedule(spark, sf_dir):
    return E.replay_schedule(events(spark, sf_dir), speed=10).select(*SCHEDULE_COLUMNS)


@query(schedule_sql("match_id % 3"))
def replay_schedule_in_ranges(spark, sf_dir):
    """Three very large matches, which are cut into ranges."""
    large = events(spark, sf_dir).withColumn("match_id", F.col("match_id") % 3)
    schedule = E.replay_schedule(large, speed=10)
    return schedule.select(*SCHEDULE_COLUMNS)


@query(
    with_ctes(
        *SIDES,
        select="""SELECT team_id, season_id, CAST(sum(pts) AS BIGINT) AS points FROM sides
 GROUP BY team_id, season_id HAVING sum(pts) > 100""",
    )
)
def having_on_aggregate(spark, sf_dir):
    totals = sides(spark, sf_dir, "season_id").groupBy("team_id", "season_id").agg(F.sum("pts").alias("points"))
    return totals.filter("points > 100")
