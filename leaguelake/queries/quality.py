"""Contracts and quality checks over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.operators import quality as Q
from leaguelake.operators.history import latest_per_key
from leaguelake.plans import marts
from leaguelake.plans.adapters import NEWEST, cte, load, table
from leaguelake.queries.league import matches
from leaguelake.queries.league import table as league
from leaguelake.queries.registry import LEAGUE, PRIMARY, newest, query, with_ctes

# Orders as feed records with planted faults; the text is built the same way by both engines.
KEY = "CAST(o_orderkey AS STRING)"
RECORD = f"""'{{' || CASE o_orderkey % 11 WHEN 0 THEN '' WHEN 1 THEN '"id":null,' WHEN 2 THEN '"id":"x",'
 WHEN 3 THEN '"id":1.5,' ELSE '"id":' || {KEY} || ',' END || '"utcDate":"2024-01-01T15:00:00Z",'
 || CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN '"status":null,' WHEN 2 THEN '"status":"ABANDONED",'
 ELSE '"status":"FINISHED",' END || '"matchday":' || CAST(o_orderkey % 41 AS STRING) || ','
 || CASE o_orderkey % 13 WHEN 0 THEN '"homeTeam":"none",' WHEN 1 THEN '"homeTeam":{{"id":1}},'
 ELSE '"homeTeam":{{"id":1,"name":"A"}},' END
 || '"awayTeam":{{"id":2,"name":"B"}}}}'"""
ENUM = str(values.MATCH_CONTRACT["enums"]["status"]).replace("'", "''")
VIOLATIONS = f"""violations AS (
 SELECT o_orderkey, 'id' AS field, 'required' AS rule, 'Missing required field: id' AS message, 'ERROR' AS severity
 FROM orders WHERE o_orderkey % 11 = 0
 UNION ALL SELECT o_orderkey, 'status', 'required', 'Missing required field: status', 'ERROR' FROM orders
 WHERE o_orderkey % 7 = 0
 UNION ALL SELECT o_orderkey, 'id', 'type', 'Expected int, got ' || CASE o_orderkey % 11 WHEN 2 THEN 'str'
 ELSE 'float' END, 'ERROR' FROM orders WHERE o_orderkey % 11 IN (2, 3)
 UNION ALL SELECT o_orderkey, 'status', 'enum', 'Value ''' || CASE o_orderkey % 7 WHEN 1 THEN 'None' ELSE 'ABANDONED'
 END || ''' not in allowed values: {ENUM}', 'WARN' FROM orders WHERE o_orderkey % 7 IN (1, 2)
 UNION ALL SELECT o_orderkey, 'matchday', 'range', 'Value ' || CAST(o_orderkey % 41 AS STRING)
 || ' outside range [1, 38]', 'ERROR' FROM orders WHERE o_orderkey % 41 NOT BETWEEN 1 AND 38
 UNION ALL SELECT o_orderkey, 'homeTeam.name', 'nested_required', 'Missing nested field: homeTeam.name', 'ERROR'
 FROM orders WHERE o_orderkey % 13 = 1)"""
FAILED = "failed AS (SELECT DISTINCT o_orderkey FROM violations WHERE severity = 'ERROR')"


def records(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{RECORD} AS raw_json")


@query(with_ctes(VIOLATIONS, select="SELECT * FROM violations"))
def contract_violations(spark, sf_dir):
    return Q.violations(records(spark, sf_dir), values.MATCH_CONTRACT, ["o_orderkey"])


@query(
    with_ctes(
        VIOLATIONS,
        FAILED,
        select="""SELECT 'football_data_match' AS contract_name, f <= 0.1 * n AS valid, n AS records_checked,
 n - f AS records_passed, CAST(n - f AS DOUBLE) / n AS pass_rate FROM (SELECT (SELECT count(*) FROM orders) AS n,
 (SELECT count(*) FROM failed) AS f)""",
    )
)
def contract_gate(spark, sf_dir):
    return Q.contract_gate(records(spark, sf_dir), values.MATCH_CONTRACT)


@query(
    with_ctes(
        VIOLATIONS,
        FAILED,
        select="""SELECT o.o_orderkey, CASE WHEN f.o_orderkey IS NULL THEN 'accepted' ELSE 'quarantined' END AS verdict
 FROM orders o LEFT JOIN failed f ON f.o_orderkey = o.o_orderkey""",
    )
)
def quarantine(spark, sf_dir):
    good, bad = Q.quarantine(records(spark, sf_dir), values.MATCH_CONTRACT)
    return good.select("o_orderkey", F.lit("accepted").alias("verdict")).unionAll(
        bad.select("o_orderkey", F.lit("quarantined").alias("verdict"))
    )


# Orders as standings records.
STANDING = f"""'{{"position":' || CAST(o_orderkey % 23 AS STRING) || ',"team":{{"id":1,"name":"A"}},"playedGames":'
 || CAST(o_custkey % 40 AS STRING) || ',"won":1,"draw":1,"lost":1,"points":' || CAST(o_orderkey % 119 - 2 AS STRING)
 || ',"goalsFor":3,"goalsAgainst":2,"goalDifference":' || CASE o_orderkey % 5 WHEN 0 THEN 'null' ELSE '1' END || '}}'"""


def outside(field: str, value: str, low: int, high: int) -> str:
    return f"""SELECT o_orderkey, '{field}' AS field, 'range' AS rule, 'Value ' || CAST({value} AS STRING)
 || ' outside range [{low}, {high}]' AS message, 'ERROR' AS severity FROM orders
 WHERE {value} NOT BETWEEN {low} AND {high}"""


@query(
    " UNION ALL ".join(
        [
            outside("position", "o_orderkey % 23", 1, 20),
            outside("playedGames", "o_custkey % 40", 0, 38),
            outside("points", "(o_orderkey % 119 - 2)", 0, 114),
        ]
    )
)
def standings_contract_violations(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{STANDING} AS raw_json")
    return Q.violations(rows, values.STANDINGS_CONTRACT, ["o_orderkey"])


def check_sql(name, category, passed, message, value, source, severity="critical"):
    return f"""SELECT '{name}' AS name, '{category}' AS category, {passed} AS passed, '{severity}' AS severity,
 {message} AS message, CAST({value} AS STRING) AS value FROM {source}"""


def counted(n: str) -> str:
    return f"format('{{:,}}', {n})"


COUNTS = [
    check_sql("orders exists", "schema", "TRUE", f"{counted('n')} || ' rows'", "n", "(SELECT count(*) n FROM orders)"),
    check_sql(
        "orders ≥ 300", "row_count", "n >= 300", f"{counted('n')} || ' rows (300 or more)'", "n",
        "(SELECT count(*) n FROM orders)",
    ),
    check_sql(
        "orders ≥ 10,000,000", "row_count", "n >= 10000000", f"{counted('n')} || ' rows (many)'", "n",
        "(SELECT count(*) n FROM orders)", "warning",
    ),
]
NULLS = [
    check_sql(
        f"scorers.{c} not null", "completeness", "n = 0", "CAST(n AS STRING) || ' nulls found'", "n",
        f"(SELECT count(*) n FROM scorers WHERE {c} IS NULL)",
    )
    for c in ("player_id", "goals")
]


@query(" UNION ALL ".join(COUNTS))
def row_count_checks(spark, sf_dir):
    return Q.run_checks(
        table(spark, sf_dir, "orders"),
        [
            Q.exists_check("orders"),
            Q.row_count_check("orders", 300, "300 or more"),
            Q.row_count_check("orders", 10_000_000, "many", "warning"),
        ],
    )


def unique_sql(name: str, source: str, column: str) -> str:
    return check_sql(
        f"{name}.{column} unique", "uniqueness", "n = d",
        f"{counted('d')} || ' distinct / ' || {counted('n')} || ' total'",
        "CAST(d AS STRING) || '/' || CAST(n AS STRING)",
        f"(SELECT count(*) n, count(DISTINCT {column}) d FROM {source})",
    )


@query(" UNION ALL ".join([unique_sql("orders", "orders", "o_orderkey"), unique_sql("labels", "labels", "doc_id"),
                           unique_sql("lineitem", "lineitem", "l_orderkey")]))
def uniqueness_checks(spark, sf_dir):
    return Q.report(
        Q.unique_check(table(spark, sf_dir, "orders"), "orders", "o_orderkey"),
        Q.unique_check(table(spark, sf_dir, "labels"), "labels", "doc_id"),
        Q.unique_check(table(spark, sf_dir, "lineitem"), "lineitem", "l_orderkey"),
    )


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def repeated_keys(spark, sf_dir):
    return Q.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(with_ctes(cte("scorers"), select=" UNION ALL ".join(NULLS)))
def completeness_checks(spark, sf_dir):
    return Q.run_checks(
        load(spark, sf_dir, "scorers"),
        [Q.not_null_check("scorers", "player_id"), Q.not_null_check("scorers", "goals")],
    )


def rule_sql(name: str, source: str, broken: str, message: str) -> str:
    return check_sql(
        name, "business_rule", "n = 0", f"CAST(n AS STRING) || '{message}'", "n",
        f"(SELECT count(*) n FROM {source} WHERE {broken})",
    )


RULES = [
    rule_sql("No negative points", "league", "points < 0", " teams with negative points"),
    rule_sql("Points = W*3 + D", "league", "points != won * 3 + drawn", " teams with inconsistent points"),
    rule_sql("Played = W + D + L", "league", "played != won + drawn + lost", " teams with inconsistent game count"),
    rule_sql(
        "GD = GF - GA", "league", "goal_difference != goals_for - goals_against",
        " teams with inconsistent goal difference",
    ),
    rule_sql("No negative scores", "clean", "home_score < 0 OR away_score < 0", " matches with negative scores"),
    rule_sql("All scorers have goals > 0", "scorers", "goals <= 0", " scorers with 0 goals"),
]


def rules(spark, sf_dir):
    return Q.report(
        Q.run_checks(league(spark, sf_dir), Q.TABLE_RULES),
        Q.run_checks(matches(spark, sf_dir), Q.RESULT_RULES),
        Q.run_checks(load(spark, sf_dir, "scorers"), Q.SCORER_RULES),
    )


@query(with_ctes(*LEAGUE, cte("scorers"), select=" UNION ALL ".join(RULES)))
def business_rules(spark, sf_dir):
    return rules(spark, sf_dir)


ORPHANS = check_sql(
    "All labelled documents known", "referential", "n = 0", "CAST(n AS STRING) || ' orphan teams in results'", "n",
    "(SELECT count(DISTINCT doc_id) n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))", "warning",
)


@query(ORPHANS)
def reference_check(spark, sf_dir):
    return Q.reference_check(
        table(spark, sf_dir, "documents"), "doc_id", table(spark, sf_dir, "labels"), "doc_id",
        "All labelled documents known",
    )


@query(
    with_ctes(
        *LEAGUE,
        cte("scorers"),
        f"checks AS ({' UNION ALL '.join([*RULES, *COUNTS, ORPHANS])})",
        select="""SELECT count(*) AS total, count(*) FILTER (WHERE passed) AS passed,
 count(*) FILTER (WHERE NOT passed AND severity = 'critical') AS failed,
 count(*) FILTER (WHERE NOT passed AND severity = 'warning') AS warnings,
 count(*) FILTER (WHERE NOT passed AND severity = 'critical') = 0 AS gate_open FROM checks""",
    )
)
def quality_report(spark, sf_dir):
    return Q.report_summary(
        Q.report(rules(spark, sf_dir), row_count_checks(spark, sf_dir), reference_check(spark, sf_dir))
    )


@query(
    """SELECT count(*) AS total, count(*) FILTER (WHERE event_type IN ('view', 'click')) AS passed,
 count(*) FILTER (WHERE event_type = 'error') AS failed, count(*) FILTER (WHERE event_type = 'signup') AS warned
 FROM events"""
)
def status_totals(spark, sf_dir):
    status = F.expr(
        "CASE WHEN event_type IN ('view', 'click') THEN 'pass' WHEN event_type = 'error' THEN 'fail' "
        "WHEN event_type = 'signup' THEN 'warn' ELSE 'skipped' END"
    )
    return Q.status_totals(table(spark, sf_dir, "events").withColumn("status", status))


INVENTORY = {"orders": ("raw", 6), "lineitem": ("raw", 11), "events": ("staging", 6), "documents": ("mart", 5)}
INVENTORY_SQL = " UNION ALL ".join(
    f"""SELECT '{schema}' AS schema, '{t}' AS "table", count(*) AS row_count, CAST({n} AS BIGINT) AS column_count,
 '{values.LAYERS[schema]}' AS layer FROM {t}"""
    for t, (schema, n) in INVENTORY.items()
)


def tables(spark, sf_dir):
    return {t: (schema, table(spark, sf_dir, t)) for t, (schema, _) in INVENTORY.items()}


@query(INVENTORY_SQL)
def table_inventory(spark, sf_dir):
    return Q.inventory(tables(spark, sf_dir))


@query(
    f"""SELECT layer, count(*) AS tables, CAST(sum(row_count) AS BIGINT) AS total_rows FROM ({INVENTORY_SQL})
 GROUP BY layer"""
)
def layer_totals(spark, sf_dir):
    return Q.layer_totals(Q.inventory(tables(spark, sf_dir)))


def as_of(text: str):
    return F.lit(text).cast("timestamp_ntz")


def age(t: str, time: str, now: str, warn: int, error: int) -> str:
    hours = f"(epoch(TIMESTAMP '{now}') - epoch(max({time}))) / 3600"
    return f"""SELECT '{t}' AS "table", max({time}) AS last_updated, round({hours}, 2) AS hours_ago,
 CASE WHEN {hours} <= {warn} THEN 'pass' WHEN {hours} <= {error} THEN 'warn' ELSE 'error' END AS status FROM {t}"""


@query(
    age("events", "ts", "2024-01-31 03:00:00", 2, 6) + " UNION ALL "
    + age("orders", "o_orderdate", "2001-08-01 12:00:00", 24, 48)
)
def freshness(spark, sf_dir):
    return Q.report(
        Q.freshness(table(spark, sf_dir, "events"), "events", "ts", as_of("2024-01-31 03:00:00"), 2, 6),
        Q.freshness(table(spark, sf_dir, "orders"), "orders", "o_orderdate", as_of("2001-08-01 12:00:00"), 24, 48),
    )


@query(
    with_ctes(
        cte("live_matches"),
        select=f"""SELECT *, CASE WHEN freshness_minutes <= 20 THEN 'PASS_MATCHDAY_SLA' WHEN freshness_minutes <= 90
 THEN 'PASS_OFFDAY_SLA' ELSE 'FAIL' END AS freshness_status, TIMESTAMP '2001-11-04 06:00:00' AS computed_at FROM (
 SELECT count(*) AS active_match_count, max(ingested_at) AS last_ingested_at,
 greatest(0, date_diff('minute', max(ingested_at), TIMESTAMP '2001-11-04 06:00:00')) AS freshness_minutes
 FROM {newest('live_matches', 'match_id')})""",
    )
)
def live_match_monitor(spark, sf_dir):
    return marts.live_match_monitor(load(spark, sf_dir, "live_matches"), as_of("2001-11-04 06:00:00"), NEWEST)


@query(
    """SELECT 'events' AS "table", n AS recent_rows, CASE WHEN n > 0 THEN 'success' ELSE 'warn' END AS status
 FROM (SELECT count(*) FILTER (WHERE ts >= TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 2 HOUR) AS n FROM events)
 UNION ALL SELECT 'orders', n, CASE WHEN n > 0 THEN 'success' ELSE 'warn' END
 FROM (SELECT count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '2024-01-30 20:00:00' - INTERVAL 2 HOUR) AS n
 FROM orders)"""
)
def recent_rows(spark, sf_dir):
    now = as_of("2024-01-30 20:00:00")
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "ts")
    return Q.recent_rows({"events": table(spark, sf_dir, "events"), "orders": orders}, now, time="ts")


@query(
    with_ctes(
        cte("live_matches"),
        select=f"""SELECT n AS matches_near, n > 0 AS is_matchday FROM (SELECT count(*) AS n
 FROM {newest('live_matches', 'match_id', PRIMARY)} WHERE CAST(utc_date AS DATE) BETWEEN DATE '1998-02-28'
 AND DATE '1998-03-02')""",
    )
)
def active_matchday(spark, sf_dir):
    source = F.col("source") == values.PRIMARY_SOURCE
    latest = latest_per_key(load(spark, sf_dir, "live_matches").filter(source), ["match_id"], NEWEST)
    return Q.active_matchday(latest, F.lit("1998-03-01").cast("date"))
