"""Streaming jobs over the given event table, run until everything available is processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from leaguelake import values
from leaguelake.plans.adapters import ADAPTERS, NEWEST, cte, load, table
from leaguelake.queries.quality import FAILED, RECORD, VIOLATIONS
from leaguelake.queries.registry import EVENTS, GOAL, newest, query, with_ctes
from leaguelake.session import new_folder
from leaguelake.streaming import live as L


def stream(spark, sf_dir, name):
    """A given table as a stream of files."""
    return L.read_folder(spark, sf_dir, table(spark, sf_dir, name).schema, f"{name}.parquet")


def adapted(spark, sf_dir, adapter):
    source, columns = ADAPTERS[adapter]
    return stream(spark, sf_dir, source).selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def events(spark, sf_dir):
    return adapted(spark, sf_dir, "match_events")


def run(spark, streaming_df, mode, each=None):
    path = new_folder(spark, "stream")
    L.run_to_table(streaming_df, path, new_folder(spark, "stream-checkpoint"), mode, each)
    return path


def run_value(spark, streaming_df, value):
    path = new_folder(spark, "running")
    L.run_running(streaming_df, path, new_folder(spark, "stream-checkpoint"), value)
    return L.running_value(spark, path, value)


WRITERS = 4  # files of a micro-batch


def run_restarted(spark, sf_dir, name, columns, value, order):
    """A table dealt to eight deals of WRITERS files in the order of a hash, one deal for each micro-batch, which land before the first
    run, before a second and before a third run of the stream: most rows come late. A landing reads the table once, whatever the number of its
    files, and sends each row straight to its file."""
    landed, path, checkpoint = (new_folder(spark, x) for x in ("landed", "running", "stream-checkpoint"))
    given = table(spark, sf_dir, name)
    file = F.pmod(F.xxhash64(order), F.lit(8 * WRITERS)).cast("int")
    for first, last in ((0, 3), (3, 6), (6, 8)):
        here = given.filter(file.between(first * WRITERS, last * WRITERS - 1))
        dealt = here.repartitionById((last - first) * WRITERS, file - first * WRITERS)
        dealt.write.mode("append").parquet(landed)
        stream = spark.readStream.schema(given.schema).option("maxFilesPerTrigger", WRITERS).parquet(landed)
        L.run_running(stream.selectExpr(*columns), path, checkpoint, value, every=3)
    return L.running_value(spark, path, value)


def restarted(spark, sf_dir, adapter, value, order):
    source, columns = ADAPTERS[adapter]
    return run_restarted(spark, sf_dir, source, [f"{e} AS {n}" for n, e in columns.items()], value, order)


COUNTS = "counts AS (SELECT match_id, event_type, count(*) AS n FROM match_events GROUP BY ALL)"
TOUCH = "event_type IN ('Pass', 'Carry', 'Ball Receipt*', 'Dribble', 'Shot')"


@query(
    with_ctes(
        *EVENTS,
        COUNTS,
        select="""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY match_id ORDER BY n DESC, event_type) AS place
 FROM counts) WHERE place <= 8""",
    )
)
def stream_counts_by_type(spark, sf_dir):
    return L.top_types(run_value(spark, events(spark, sf_dir), L.COUNTS_BY_TYPE))


@query(with_ctes(*EVENTS, COUNTS, select="SELECT * FROM counts"))
def stream_counts_restarted(spark, sf_dir):
    return restarted(spark, sf_dir, "match_events", L.COUNTS_BY_TYPE, "event_id")


@query(
    with_ctes(
        *EVENTS,
        select="""SELECT match_id, team_name, count(*) FILTER (WHERE event_type = 'Pass') AS pass,
 count(*) FILTER (WHERE event_type = 'Shot') AS shot, count(*) FILTER (WHERE event_type = 'Foul Committed')
 AS foul_committed FROM match_events GROUP BY ALL""",
    )
)
def stream_team_comparison(spark, sf_dir):
    counts = run_value(spark, events(spark, sf_dir), L.COUNTS_BY_TEAM)
    return L.compare_teams(counts, ["Pass", "Shot", "Foul Committed"])


@query(
    with_ctes(
        *EVENTS,
        select=f"""SELECT match_id, team_name, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY match_id) * 100, 0)
 AS possession_pct FROM (SELECT match_id, team_name, count(*) AS n FROM match_events WHERE {TOUCH} GROUP BY ALL)""",
    )
)
def stream_possession(spark, sf_dir):
    return L.possession(run_value(spark, events(spark, sf_dir), L.TOUCHES))


@query(
    with_ctes(
        *EVENTS,
        select=f"""SELECT match_id, event_id, minute, second, CASE WHEN minute < 10 THEN '0' ELSE '' END
 || CAST(minute AS STRING) || ':' || CASE WHEN second < 10 THEN '0' ELSE '' END || CAST(second AS STRING) AS clock,
 coalesce(player_name, 'Unknown') AS player, team_name AS team FROM match_events WHERE {GOAL}""",
    )
)
def stream_goals(spark, sf_dir):
    return L.all_epochs(spark, run(spark, L.goal_stream(events(spark, sf_dir)), "append"))


@query("SELECT date_trunc('second', ts) AS second_start, count(*) AS events FROM events GROUP BY ALL")
def stream_events_per_second(spark, sf_dir):
    """The table is dealt to eight files in the order of a hash, one for each micro-batch: most events come late."""
    path = new_folder(spark, "events-in-files")
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    table.repartition(8, F.xxhash64("event_id")).write.parquet(path)
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = L.add_up(L.all_epochs(spark, run(spark, source, "append", L.second_counts)), ["second_start"])
    return out.withColumn("second_start", F.col("second_start").cast("timestamp_ntz"))


@query(
    with_ctes(
        *EVENTS,
        select=f"""SELECT match_id, count(*) AS seen, count(*) FILTER (WHERE {GOAL}) AS goals_so_far, count(*) AS total,
 CAST(100 AS DOUBLE) AS progress_pct FROM match_events GROUP BY match_id""",
    )
)
def stream_progress(spark, sf_dir):
    totals = load(spark, sf_dir, "match_events").groupBy("match_id").agg(F.count(F.lit(1)).alias("total"))
    return L.with_progress(run_value(spark, events(spark, sf_dir), L.PROGRESS), totals)


@query(
    with_ctes(
        *EVENTS,
        select=f"""SELECT match_id, count(*) FILTER (WHERE event_id % 3 = 0) AS seen,
 count(*) FILTER (WHERE event_id % 3 = 0 AND {GOAL}) AS goals_so_far, count(*) AS total,
 round(CAST(count(*) FILTER (WHERE event_id % 3 = 0) AS DOUBLE) / count(*) * 100, 1) AS progress_pct
 FROM match_events GROUP BY match_id HAVING count(*) FILTER (WHERE event_id % 3 = 0) > 0""",
    )
)
def stream_progress_midway(spark, sf_dir):
    """A third of the events have arrived; totals are those of the whole matches."""
    totals = load(spark, sf_dir, "match_events").groupBy("match_id").agg(F.count(F.lit(1)).alias("total"))
    arrived = events(spark, sf_dir).filter("event_id % 3 = 0")
    return L.with_progress(run_value(spark, arrived, L.PROGRESS), totals)


@query(
    with_ctes(
        *EVENTS, select=f"SELECT match_id, team_name, count(*) AS goals FROM match_events WHERE {GOAL} GROUP BY ALL"
    )
)
def stream_running_score(spark, sf_dir):
    return run_value(spark, events(spark, sf_dir), L.RUNNING_SCORE)


@query(
    with_ctes(
        *EVENTS, select=f"SELECT match_id, team_name, count(*) AS goals FROM match_events WHERE {GOAL} GROUP BY ALL"
    )
)
def stream_running_score_restarted(spark, sf_dir):
    return restarted(spark, sf_dir, "match_events", L.RUNNING_SCORE, "event_id")


@query("SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def stream_feed(spark, sf_dir):
    path = new_folder(spark, "feed")
    rows = stream(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    L.run_feed(rows, path, new_folder(spark, "stream-checkpoint"), ["-ts", "-event_id"])
    return L.last_epoch(spark, path)


@query(
    with_ctes(
        VIOLATIONS,
        FAILED,
        select="""SELECT o_orderkey, f.o_orderkey IS NULL AS accepted, TIMESTAMP '2024-01-01 10:00:00' AS ingested_at
 FROM orders LEFT JOIN failed f USING (o_orderkey)""",
    )
)
def stream_poll(spark, sf_dir):
    """Landed records are checked against the contract and appended with an ingest time; a second poll adds none."""
    path, checkpoint = new_folder(spark, "polled"), new_folder(spark, "stream-checkpoint")
    at = F.lit("2024-01-01 10:00:00").cast("timestamp_ntz")
    for _ in range(2):
        feed = stream(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{RECORD} AS raw_json")
        L.poll(L.checked_records(feed, values.MATCH_CONTRACT), path, checkpoint, at)
    return L.all_epochs(spark, path).select("o_orderkey", "accepted", "ingested_at")


@query(
    with_ctes(
        cte("live_matches"),
        select=f"""SELECT match_id, status, home_score, away_score, ingested_at, ingest_seq
 FROM {newest('live_matches', 'match_id')}""",
    )
)
def stream_latest_state(spark, sf_dir):
    rows = adapted(spark, sf_dir, "live_matches").select(*STATE)
    return run_value(spark, rows, L.latest(["match_id"], NEWEST))


STATE = ["match_id", "status", "home_score", "away_score", "ingested_at", "ingest_seq"]


@query(
    with_ctes(
        cte("live_matches"),
        select=f"""SELECT match_id, status, home_score, away_score, ingested_at, ingest_seq
 FROM {newest('live_matches', 'match_id')}""",
    )
)
def stream_latest_state_restarted(spark, sf_dir):
    source, columns = ADAPTERS["live_matches"]
    wanted = [f"{columns[n]} AS {n}" for n in STATE]
    return run_restarted(spark, sf_dir, source, wanted, L.latest(["match_id"], NEWEST), "l_orderkey")
