"""Running match statistics, landing and live state as Structured Streaming jobs.

Transformations take a streaming DataFrame and return one, so they work with any source. ``run_to_table`` drives a
stream over everything that is available and writes each micro-batch as its own partition ``epoch=<id>``: a repeated
batch overwrites its partition, so results are exactly once.

Running values need no state in the stream: ``run_running`` writes what a micro-batch adds, and every ``COMPACT_AFTER`` epochs merges
these parts into one current table. A reader merges the current table with the epochs since; parts that are merged are
removed one compaction later, so that a reader who has just begun still finds them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leaguelake import values
from leaguelake.functions import columns as C
from leaguelake.operators.events import event_counts, goals, is_goal
from leaguelake.operators.history import latest_per_key
from leaguelake.operators.ordered import sort_columns
from leaguelake.operators.quality import has_error, with_violations
from leaguelake.sources.landing import read_or_none, stamped

EPOCH = "epoch"


def read_folder(spark: SparkSession, path: str, schema: T.StructType, files: str = "*", per_batch: int = 1000):
    """A stream over Parquet files that appear in a folder, at most ``per_batch`` files per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", per_batch)
        .parquet(path)
    )


def run_to_table(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "append",
    each: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Process everything available, then stop; ``each`` is applied to every micro-batch before it is written."""

    def write(batch: DataFrame, epoch: int) -> None:
        rows = batch if each is None else each(batch)
        rows.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


# running values ---------------------------------------------------------------------------------------------------

COMPACT_AFTER = 8  # epochs
OPEN, CURRENT, COMPACTED = "epochs", "current", "compacted"


@dataclass(frozen=True)
class Running:
    """A running value: what a micro-batch adds, and how parts are merged, in any order and grouping."""

    part: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


def counted(count: str, *keys: str, of: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Running:
    """Counts per key."""
    return Running(
        lambda rows: event_counts(of(rows), *keys).withColumnRenamed("n", count),
        lambda parts: parts.groupBy(*keys).agg(F.sum(count).alias(count)),
    )


def latest(keys: Sequence[str], order_by: Sequence[str]) -> Running:
    """The first row of each key in ``order_by``."""
    return Running(lambda rows: latest_per_key(rows, list(keys), list(order_by)), lambda parts: latest_per_key(parts, list(keys), list(order_by)))


def compacted_until(spark: SparkSession, path: str) -> list[int]:
    """The last epochs of the compactions that are complete, newest first."""
    log = read_or_none(spark, f"{path}/{COMPACTED}")
    return [] if log is None else [r.until for r in log.select("until").distinct().orderBy(F.desc("until")).collect()]


def open_epochs(spark: SparkSession, path: str, after: int) -> DataFrame | None:
    """Parts of the epochs after the current table; Spark lists folders and reads those alone."""
    parts = read_or_none(spark, f"{path}/{OPEN}")
    return None if parts is None else parts.filter(F.col(EPOCH) > after).drop(EPOCH)


def running_value(spark: SparkSession, path: str, value: Running) -> DataFrame:
    """The running value now: the current table, and the epochs since it was made."""
    done = compacted_until(spark, path)
    parts = open_epochs(spark, path, done[0] if done else -1)
    if done:
        current = spark.read.parquet(f"{path}/{CURRENT}/until={done[0]}")
        parts = current if parts is None else current.unionByName(parts)
    return value.merge(parts)


def compact(spark: SparkSession, path: str, value: Running, until: int) -> None:
    """Merge the current table and the epochs up to ``until`` into the next current table. It counts once it is noted; a
    repeated call writes the same table again."""
    done = compacted_until(spark, path)
    if done and done[0] >= until:
        return
    running_value(spark, path, value).write.mode("overwrite").parquet(f"{path}/{CURRENT}/until={until}")
    spark.createDataFrame([(until,)], "until long").coalesce(1).write.mode("append").parquet(f"{path}/{COMPACTED}")
    if done:
        remove(spark, [f"{path}/{CURRENT}/until={e}" for e in done[1:]], f"{path}/{OPEN}", done[0])


def remove(spark: SparkSession, folders: Sequence[str], epochs: str, until: int) -> None:
    """Delete tables before the last but one, and the epochs that it already contains."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(epochs)
    files = place.getFileSystem(conf)
    old = [x.getPath() for x in files.listStatus(place) if x.getPath().getName().startswith(f"{EPOCH}=")]
    gone = [x for x in old if int(x.getName().partition("=")[2]) <= until]
    for x in [*map(jvm.org.apache.hadoop.fs.Path, folders), *gone]:
        files.delete(x, True)


def run_running(stream: DataFrame, path: str, checkpoint: str, value: Running, every: int = COMPACT_AFTER) -> None:
    """Process everything available, then stop. The stream itself is stateless, so it can be stopped for any time, and
    late rows count."""
    spark = stream.sparkSession

    def write(batch: DataFrame, epoch: int) -> None:
        if epoch and epoch % every == 0:  # before the epoch is written: all earlier ones are complete
            compact(spark, path, value, epoch - 1)
        value.part(batch).write.mode("overwrite").parquet(f"{path}/{OPEN}/{EPOCH}={epoch}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    )
    query.awaitTermination()


def all_epochs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).drop(EPOCH)


# statistics -------------------------------------------------------------------------------------------------------


#: Running count per match and event type.
COUNTS_BY_TYPE = counted("n", "match_id", "event_type")

#: Running count per match, team and event type.
COUNTS_BY_TEAM = counted("n", "match_id", "team_name", "event_type")


def top_types(counts: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` most frequent event types of each match."""
    window = Window.partitionBy("match_id").orderBy(F.desc("n"), "event_type")
    return counts.withColumn("place", F.row_number().over(window).cast("long")).filter(F.col("place") <= n)


def compare_teams(counts: DataFrame, types: Sequence[str]) -> DataFrame:
    """One row per match and team with the named event types as columns, 0 where there are none."""
    return counts.groupBy("match_id", "team_name").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("event_type") == t, F.col("n"))), F.lit(0)).alias(
                t.lower().replace(" ", "_").replace("*", "")
            )
            for t in types
        ]
    )


def touch_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type").isin(*values.TOUCH_EVENTS) & F.col("team_name").isNotNull())


#: Running count of ball touches per match and team.
TOUCHES = counted("n", "match_id", "team_name", of=touch_events)


def possession(touch_counts: DataFrame) -> DataFrame:
    """Share of the touches of a match in whole percent."""
    total = F.sum("n").over(Window.partitionBy("match_id"))
    return touch_counts.withColumn("possession_pct", C.round_to(C.safe_divide("n", total) * 100, 0))


def goal_stream(events: DataFrame) -> DataFrame:
    return goals(events).select(
        "match_id",
        "event_id",
        "minute",
        "second",
        C.clock("minute", "second").alias("clock"),
        F.coalesce("player_name", F.lit("Unknown")).alias("player"),
        F.coalesce("team_name", F.lit("Unknown")).alias("team"),
    )


def second_counts(events: DataFrame, time: str = "ts") -> DataFrame:
    """Events per second of the rows at hand: what one micro-batch adds, however late its events are."""
    second = F.date_trunc("second", F.col(time).cast("timestamp")).alias("second_start")
    return events.groupBy(second).agg(F.count(F.lit(1)).alias("events"))


def add_up(parts: DataFrame, keys: Sequence[str], count: str = "events") -> DataFrame:
    """Totals of the counts that micro-batches have written; a repeated micro-batch has replaced its own."""
    return parts.groupBy(*keys).agg(F.sum(count).alias(count))


def events_per_second(events: DataFrame, time: str = "ts", late: str = "10 minutes") -> DataFrame:
    """Events per second for append mode: rows later than the watermark are dropped and old windows leave the
    state. ``second_counts`` with ``add_up`` counts every row."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    return (
        timed.withWatermark(time, late)
        .groupBy(F.window(time, "1 second").alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("second_start"), "events")
    )


#: Events seen and goals so far per match.
PROGRESS = Running(
    lambda events: events.groupBy("match_id").agg(F.count(F.lit(1)).alias("seen"), F.count_if(is_goal()).alias("goals_so_far")),
    lambda parts: parts.groupBy("match_id").agg(F.sum("seen").alias("seen"), F.sum("goals_so_far").alias("goals_so_far")),
)


def with_progress(seen: DataFrame, totals: DataFrame) -> DataFrame:
    """Percent of each match's known number of events."""
    return seen.join(totals, "match_id").withColumn(
        "progress_pct", C.round_to(C.safe_divide("seen", "total") * 100, 1)
    )


#: Goals so far per match and team.
RUNNING_SCORE = counted("goals", "match_id", "team_name", of=goals)


def run_feed(stream: DataFrame, path: str, checkpoint: str, order_by: Sequence[str], n: int = 100) -> None:
    """Keep the newest ``n`` events.

    A micro-batch is cut to its own top ``n`` before the feed so far is added, so a step handles 2n rows at most.
    """
    spark = stream.sparkSession

    def top(rows: DataFrame) -> DataFrame:
        return rows.orderBy(*sort_columns(order_by)).limit(n)

    def write(batch: DataFrame, epoch: int) -> None:
        best = top(batch)
        if epoch > 0:
            best = top(best.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/{EPOCH}={epoch - 1}")))
        best.write.mode("overwrite").parquet(f"{path}/{EPOCH}={epoch}")

    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
        .start()
    )
    query.awaitTermination()


def last_epoch(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("basePath", path).parquet(path)
    return rows.filter(F.col(EPOCH) == rows.agg(F.max(EPOCH)).scalar()).drop(EPOCH)


# landing and state ------------------------------------------------------------------------------------------------


def checked_records(feed: DataFrame, contract, record: str = "raw_json") -> DataFrame:
    """Records of a feed with their violations and a verdict; also usable on a stream."""
    return with_violations(feed, contract, record).withColumn("accepted", ~has_error())


def poll(feed: DataFrame, path: str, checkpoint: str, at: Column | None = None) -> None:
    """Take in everything that has landed since the last call and append it with an ingest time."""
    run_to_table(feed, path, checkpoint, each=lambda batch: stamped(batch, at))
