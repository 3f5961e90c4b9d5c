"""Landed tables and exports: written to the shared folder, changed, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaguelake.plans import marts
from leaguelake.plans.adapters import NEWEST, cte, load, table
from leaguelake.queries import league
from leaguelake.queries.registry import CLEAN, LEAGUE, LIVE_TABLE, TEAMS, query, with_ctes
from leaguelake.session import new_folder, stored
from leaguelake.sources import exports, landing


def orders(spark, sf_dir):
    return table(spark, sf_dir, "orders")


@query("SELECT o_orderkey, o_totalprice, 'fallback' AS source_used FROM orders")
def first_available(spark, sf_dir):
    """The first source is unreadable, the second empty, the third has rows."""
    rows = orders(spark, sf_dir).select("o_orderkey", "o_totalprice")
    return landing.first_available(
        ("api", lambda: spark.read.parquet(f"{sf_dir}/no-such-table.parquet")),
        ("primary", rows.filter("o_totalprice < 0")),
        ("fallback", rows),
    )


@query(
    """SELECT o_orderkey, o_totalprice, ingested_at, CAST(ingested_at AS DATE) AS ingest_date FROM (
 SELECT o_orderkey, o_totalprice, TIMESTAMP '2024-01-01 10:00:00' AS ingested_at FROM orders UNION ALL
 SELECT o_orderkey, o_totalprice + 1, TIMESTAMP '2024-01-02 10:00:00' FROM orders WHERE o_orderstatus = 'O')"""
)
def append_bronze(spark, sf_dir):
    path = new_folder(spark, "bronze")
    rows = orders(spark, sf_dir)
    first, second = (F.lit(f"2024-01-0{d} 10:00:00").cast("timestamp_ntz") for d in (1, 2))
    landing.append_bronze(rows.select("o_orderkey", "o_totalprice"), path, first)
    changed = rows.filter("o_orderstatus = 'O'").selectExpr("o_orderkey", "o_totalprice + 1 AS o_totalprice")
    landing.append_bronze(changed, path, second)
    return spark.read.parquet(path)


@query(
    """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_returnflag = 'A'
 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey) = 1)
 UNION ALL SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_orderkey NOT IN
 (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
 QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey) = 1)"""
)
def insert_new_keys(spark, sf_dir):
    """A first batch, then all rows, then all rows again, which changes nothing."""
    path = new_folder(spark, "insert")
    rows = table(spark, sf_dir, "lineitem")
    kept = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    order = ["-l_shipdate", "l_linenumber", "l_partkey"]
    everything = rows.select(*kept)
    for batch in (rows.filter("l_returnflag = 'A'").select(*kept), everything, everything):
        landing.insert_new_keys(batch, path, ["l_orderkey"], order)
    return spark.read.parquet(path)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN -o_totalprice ELSE o_totalprice END
 AS o_totalprice, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
 OR o_orderstatus = 'F'"""
)
def replace_partitions(spark, sf_dir):
    """Two of the partitions are replaced by fewer, changed rows."""
    path = new_folder(spark, "partitions")
    rows = orders(spark, sf_dir).select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    landing.replace_partitions(rows.drop("o_orderstatus"), path, ["o_orderpriority"])
    batch = rows.filter("o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F'").selectExpr(
        "o_orderkey", "-o_totalprice AS o_totalprice", "o_orderpriority"
    )
    landing.replace_partitions(batch, path, ["o_orderpriority"])
    return spark.read.parquet(path)


@query(
    """SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_orderkey NOT IN
 (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1) UNION ALL
 SELECT l_orderkey, -l_partkey, l_returnflag FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1"""
)
def replace_keys(spark, sf_dir):
    """All rows of the batch's keys are replaced, in all partitions."""
    path = new_folder(spark, "keys")
    rows = table(spark, sf_dir, "lineitem")
    landing.replace_partitions(rows.select("l_orderkey", "l_partkey", "l_returnflag"), path, ["l_returnflag"])
    batch = rows.filter("l_returnflag = 'R' AND l_linenumber = 1").selectExpr(
        "l_orderkey", "-l_partkey AS l_partkey", "l_returnflag"
    )
    landing.replace_keys(batch, path, ["l_orderkey"], ["l_returnflag"])
    return spark.read.parquet(path)


@query(
    """SELECT l_orderkey, l_partkey, l_returnflag FROM lineitem WHERE l_orderkey NOT IN
 (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1 AND l_returnflag IN ('R', 'N')) UNION ALL
 SELECT l_orderkey, -l_partkey, CASE l_returnflag WHEN 'N' THEN 'X' ELSE 'A' END FROM lineitem
 WHERE l_linenumber = 1 AND l_returnflag IN ('R', 'N')"""
)
def replace_moved_keys(spark, sf_dir):
    """Keys move to another partition, old or new; their rows leave all partitions that had any."""
    path = new_folder(spark, "moved-keys")
    rows = table(spark, sf_dir, "lineitem")
    landing.replace_partitions(rows.select("l_orderkey", "l_partkey", "l_returnflag"), path, ["l_returnflag"])
    batch = rows.filter("l_linenumber = 1 AND l_returnflag IN ('R', 'N')").selectExpr(
        "l_orderkey", "-l_partkey AS l_partkey", "CASE l_returnflag WHEN 'N' THEN 'X' ELSE 'A' END AS l_returnflag"
    )
    landing.replace_keys(batch, path, ["l_orderkey"], ["l_returnflag"])
    return spark.read.parquet(path)


@query(
    with_ctes(
        *CLEAN,
        select="""SELECT match_id, winner, CASE WHEN matchday <= 20 THEN NULL ELSE 'late' END AS note FROM clean
 WHERE match_id IS NOT NULL""",
    )
)
def incremental_append(spark, sf_dir):
    """First run with the early matchdays, second with all of them and one more column."""
    path = new_folder(spark, "incremental")
    rows = league.matches(spark, sf_dir).select("match_id", "winner", "matchday")
    landing.incremental_append(rows.filter("matchday <= 20").drop("matchday"), path, "match_id")
    landing.incremental_append(rows.drop("matchday").withColumn("note", F.lit("late")), path, "match_id")
    return landing.read_merged(spark, path)


@query(
    """SELECT 'orders' AS pipeline_name, 'success' AS status, 'source=test' AS details, count(*) AS rows_written
 FROM orders UNION ALL SELECT 'events', 'success', '', count(*) FROM events"""
)
def run_log(spark, sf_dir):
    log = new_folder(spark, "runs")
    for name, details in (("orders", "source=test"), ("events", "")):
        landing.logged_write(table(spark, sf_dir, name), new_folder(spark, name), log, name, details)
    return spark.read.parquet(log).select("pipeline_name", "status", "details", "rows_written")


# exports ----------------------------------------------------------------------------------------------------------


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000') AS o_orderdate,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice FROM orders
 ORDER BY orders.o_orderdate DESC, o_orderkey LIMIT 380"""
)
def export_records(spark, sf_dir):
    """JSON records with ISO times; a fifth of the prices are not finite and become null."""
    path = new_folder(spark, "records")
    odd = "CASE o_orderkey % 10 WHEN 0 THEN double('NaN') WHEN 5 THEN double('-Infinity') ELSE o_totalprice END"
    rows = orders(spark, sf_dir).selectExpr("o_orderkey", "o_orderdate", f"{odd} AS o_totalprice")
    exports.export_records(rows, path, ["-o_orderdate", "o_orderkey"], 380)
    return spark.read.schema("o_orderkey long, o_orderdate string, o_totalprice double").json(path)


@query(
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE value END AS value
 FROM events"""
)
def sanitize_nonfinite(spark, sf_dir):
    odd = """CASE event_id % 4 WHEN 0 THEN double('NaN') WHEN 1 THEN double('Infinity')
 WHEN 2 THEN double('-Infinity') ELSE value END"""
    return exports.sanitize_nonfinite(table(spark, sf_dir, "events").selectExpr("event_id", f"{odd} AS value"))


@query(
    with_ctes(
        cte("match_events"),
        select="SELECT event_id, match_id, minute, second, event_type FROM match_events",
    )
)
def export_per_key(spark, sf_dir):
    path = new_folder(spark, "per-key")
    rows = load(spark, sf_dir, "match_events").select("event_id", "match_id", "minute", "second", "event_type")
    exports.export_per_key(rows, path, "event_type", ["match_id", "minute", "second", "event_id"])
    schema = "event_id long, match_id long, minute int, second int, event_type string"
    return spark.read.schema(schema).json(path)


@query(
    with_ctes(
        *LEAGUE,
        """listed AS (SELECT *, (row_number() OVER (PARTITION BY team_id ORDER BY match_date DESC, match_id) - 1) // 100
 AS part FROM sides)""",
        select="""SELECT l.team_id, l.part, count(*) AS n, string_agg(match_id, ',' ORDER BY match_date DESC, match_id)
 AS match_ids, CASE WHEN part = 0 THEN any_value(points) END AS points FROM listed l
 JOIN league USING (team_id) GROUP BY l.team_id, l.part""",
    )
)
def entity_documents(spark, sf_dir):
    """Nested team documents in parts of 100 matches."""
    rows = league.sides(spark, sf_dir, "match_id", "match_date")
    documents = exports.entity_documents(
        league.table(spark, sf_dir),
        {"matches": (rows.select("team_id", "match_id", "match_date", "result"), ["-match_date", "match_id"])},
        per_part=100,
    )
    return documents.select(
        "team_id",
        "part",
        F.size("matches").cast("long").alias("n"),
        F.array_join(F.transform("matches", lambda m: m["match_id"].cast("string")), ",").alias("match_ids"),
        F.col("standings.points").alias("points"),
    )


@query(
    with_ctes(
        *TEAMS,
        cte("scorers"),
        """listed AS (SELECT team_name, part, string_agg(match_id || ' ' || result, ',' ORDER BY recency_rank) AS matches
 FROM (SELECT *, (recency_rank - 1) // 100 AS part FROM form) GROUP BY team_name, part)""",
        """best AS (SELECT team_name, part, string_agg(player_id || ' ' || goals, ',' ORDER BY i) AS scorers FROM (
 SELECT *, (i - 1) // 100 AS part FROM (SELECT *, row_number() OVER (PARTITION BY team_name
 ORDER BY goals DESC, assists DESC, player_id) AS i FROM (SELECT * FROM scorers WHERE player_id IS NOT NULL
 QUALIFY row_number() OVER (PARTITION BY player_id ORDER BY ingested_at DESC, ingest_seq DESC) = 1)))
 GROUP BY team_name, part)""",
        """parts AS (SELECT team_name, part FROM listed UNION SELECT team_name, part FROM best
 UNION SELECT team_name, 0 FROM teams)""",
        select="""SELECT team_name, part, CASE WHEN part = 0 THEN CAST(points AS BIGINT) END AS points,
 CASE WHEN part = 0 THEN current_form END AS form, coalesce(matches, '') AS matches, coalesce(scorers, '') AS scorers
 FROM parts JOIN teams USING (team_name) LEFT JOIN listed USING (team_name, part) LEFT JOIN best USING (team_name, part)""",
    )
)
def team_documents(spark, sf_dir):
    """Documents with standings, form, matches and scorers, in parts of 100."""
    form = stored(league.form(spark, sf_dir), "form")
    rows = form.select("team_name", "match_id", "result", "recency_rank")
    scorers = marts.clean_scorers(load(spark, sf_dir, "scorers"), NEWEST)
    documents = exports.entity_documents(
        stored(marts.dim_teams(league.live_table(spark, sf_dir), form), "teams"),
        {
            "matches": (rows, ["recency_rank"]),
            "scorers": (scorers.select("team_name", "player_id", "goals", "assists"), marts.SCORER_ORDER),
        },
        key="team_name",
        per_part=100,
    )
    return documents.select(
        "team_name",
        "part",
        F.col("standings.points").cast("long").alias("points"),
        F.col("standings.current_form").alias("form"),
        F.array_join(F.transform("matches", lambda m: F.concat_ws(" ", m["match_id"], m["result"])), ",").alias("matches"),
        F.array_join(F.transform("scorers", lambda p: F.concat_ws(" ", p["player_id"], p["goals"])), ",").alias("scorers"),
    )


@query(
    with_ctes(
        cte("matches"),
        select="""SELECT match_id, match_date FROM matches WHERE match_date BETWEEN DATE '1998-02-28'
 AND DATE '1998-03-04'""",
    )
)
def date_window(spark, sf_dir):
    rows = load(spark, sf_dir, "matches").select("match_id", "match_date")
    return exports.date_window(rows, "match_date", F.lit("1998-03-01").cast("date"))


@query(with_ctes(*LIVE_TABLE, select=f"SELECT {', '.join(exports.LIVE_STANDINGS)} FROM live_table"))
def live_standings_export(spark, sf_dir):
    return exports.live_standings(league.live_table(spark, sf_dir))


@query(with_ctes(cte("matches"), select="SELECT * FROM matches WHERE season_id IN (2321, 2324)"))
def season_matches(spark, sf_dir):
    return exports.season_matches(load(spark, sf_dir, "matches"), 2321, 2324)
