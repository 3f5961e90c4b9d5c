"""Writing and maintaining landed tables: append, insert new keys, replace partitions or keys, run log.

Tables are Parquet folders. Rewrites touch whole partitions only, through dynamic partition overwrite, which stages
the new files and swaps them in when the job commits; a lost executor only repeats its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException, IllegalArgumentException

from leaguelake.operators.history import drop_repeated
from leaguelake.operators.joins import absent, present

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("rows_written", T.LongType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)


#: Conditions of a path that does not exist or holds no files yet.
NOT_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path, or None where there is none yet; any other error is the caller's."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in NOT_THERE:
            raise
        return None


UNREADABLE = (AnalysisException, IllegalArgumentException, OSError)


def first_available(*sources: tuple[str, DataFrame | Callable[[], DataFrame]], label: str = "source_used") -> DataFrame:
    """Rows of the first source that has any, with its name in ``label``.

    A source given as a function counts as empty if it cannot be read (``UNREADABLE``). Which source wins is decided inside the query
    by a scalar subquery that looks at one row per source.
    """
    frames = []
    for priority, (name, source) in enumerate(sources):
        try:
            df = source() if callable(source) else source
        except UNREADABLE:  # falls through to the next one
            continue
        frames.append((priority, df.withColumn(label, F.lit(name))))
    if not frames:
        raise ValueError("no source could be read")
    seen = [df.select(F.lit(p).alias("priority")).limit(1) for p, df in frames]
    best = reduce(DataFrame.union, seen).agg(F.min("priority")).scalar()
    tagged = [df.filter(F.lit(p) == best) for p, df in frames]
    return reduce(DataFrame.unionByName, tagged)


def sample_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """Rows of the first ``n`` keys."""
    return present(df, df.select(key).distinct().orderBy(key).limit(n), [key])


def stamped(df: DataFrame, at=None) -> DataFrame:
    """Add one ingest time for the whole batch and its date for partitioning."""
    at = F.current_timestamp() if at is None else at
    return df.withColumn("ingested_at", at).withColumn("ingest_date", F.to_date("ingested_at"))


def append_bronze(df: DataFrame, path: str, at=None) -> None:
    """Append a batch, partitioned by ingest date."""
    stamped(df, at).write.mode("append").partitionBy("ingest_date").parquet(path)


RANGES = "_key_ranges"  # beside the data; Spark does not read folders whose names begin with an underscore


def below(path: str) -> str:
    """What comes before a file's name in the table: the name that its folder ends in."""
    return f"/{path.rstrip('/').rpartition('/')[2]}/"


def written_files(spark: SparkSession, path: str) -> dict[str, str]:
    """The files of a table by their names in it."""
    table = read_or_none(spark, path)
    return {} if table is None else {f.rpartition(below(path))[2]: f for f in table.inputFiles()}


def record_ranges(spark: SparkSession, path: str, key: str) -> None:
    """Note the least and greatest key and the number of rows of each file that has no note yet.

    Only files that are new are read, and of them one column. What a lost run has not noted, the next one notes.
    """
    noted = read_or_none(spark, f"{path}/{RANGES}")
    known = set() if noted is None else {r.file for r in noted.select("file").collect()}
    new = [f for name, f in sorted(written_files(spark, path).items()) if name not in known]
    if new:
        file = F.substring_index(F.col("_metadata.file_path"), below(path), -1).alias("file")
        notes = spark.read.parquet(*new).select(file, F.col(key).alias("key")).groupBy("file")
        ranges = notes.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("n"))
        ranges.coalesce(1).write.mode("append").parquet(f"{path}/{RANGES}")


def that_may_hold(batch: DataFrame, path: str, key: str) -> DataFrame | None:
    """The files of a table whose key range meets that of the batch; None if there are none. Files without a note are read."""
    spark = batch.sparkSession
    files = written_files(spark, path)
    noted = read_or_none(spark, f"{path}/{RANGES}")
    if noted is not None and files:
        ends = batch.agg(F.min(key).alias("least"), F.max(key).alias("most")).first()
        apart = F.lit(True) if ends.least is None else (F.col("low") > F.lit(ends.most)) | (F.col("high") < F.lit(ends.least))
        for r in noted.filter(F.coalesce(apart, F.lit(True))).select("file").collect():
            files.pop(r.file, None)
    return spark.read.parquet(*sorted(files.values())) if files else None


def new_rows(batch: DataFrame, target: DataFrame | None, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Rows of the batch whose key is not in the target, one per key (the first in ``order_by``).

    The target is first reduced to keys of the batch: where the batch is small, Spark broadcasts it and the target is
    not shuffled.
    """
    once = drop_repeated(batch, keys, order_by)
    return once if target is None else absent(once, present(target.select(*keys), batch, keys), keys)


def insert_new_keys(batch: DataFrame, path: str, keys: Sequence[str], order_by: Sequence[str]) -> None:
    """Append only keys the table does not have; a second call with the same batch adds nothing. Files whose range of the first
    key column lies outside the batch's are not read."""
    target = that_may_hold(batch, path, keys[0])
    new_rows(batch, target, keys, order_by).write.mode("append").parquet(path)
    record_ranges(batch.sparkSession, path, keys[0])


def incremental_append(source: DataFrame, path: str, key: str) -> None:
    """Append rows with unseen keys; the first run writes everything, and columns may be added later on. Files whose range of
    keys lies outside the source's are not read."""
    first = not written_files(source.sparkSession, path)
    target = None if first else that_may_hold(source, path, key)
    if target is not None:
        rows = absent(source, present(target.select(key), source, [key]), [key])
    else:
        rows = source if first else source.filter(F.col(key).isNotNull())
    rows.write.mode("append").parquet(path)
    record_ranges(source.sparkSession, path, key)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A table whose files may have gained columns over time."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def replace_partitions(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Replace the partitions that occur in the batch and leave the others alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def with_replaced_keys(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target without the batch's keys, plus the batch."""
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(batch)


def replace_keys(batch: DataFrame, path: str, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Replace all rows of the batch's keys, in whatever partitions they are.

    The partitions that hold one of the keys are found by a semi join over key and partition columns; they are rewritten
    together with the batch's own in one dynamic overwrite, which leaves the table as it was if it fails. A partition that
    has no rows left is emptied after that; a run that is lost in between is made good by repeating it.
    """
    spark = batch.sparkSession
    target = read_or_none(spark, path)
    if target is None:
        replace_partitions(batch, path, partition_by)
        return
    folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("_folder")
    holding = present(target.select(*keys, *partition_by, folder), batch, keys).select(*partition_by, "_folder").distinct()
    held = {r._folder: r for r in holding.collect()}  # folders, which the driver lists anyway
    own = batch.select(*partition_by).distinct()
    touched = own.unionByName(spark.createDataFrame(list(held.values()), holding.schema).drop("_folder")) if held else own
    rows = with_replaced_keys(same_partition(target, touched.distinct(), partition_by), batch, keys)
    left = rows.select(*partition_by).distinct()
    emptied = []
    if held:
        before = spark.createDataFrame(list(held.values()), holding.schema)
        emptied = [r._folder for r in same_partition(before, left, partition_by, "left_anti").select("_folder").collect()]
    replace_partitions(rows, path, partition_by)
    bare = T.StructType([f for f in target.schema if f.name not in partition_by])
    for name in emptied:
        spark.createDataFrame([], bare).write.mode("overwrite").parquet(name)


def same_partition(df: DataFrame, partitions: DataFrame, names: Sequence[str], how: str = "left_semi") -> DataFrame:
    """Rows in one of the partitions, or in none of them; a NULL value is a partition like others."""
    on = reduce(lambda a, b: a & b, [F.col(f"rows.{n}").eqNullSafe(F.col(f"parts.{n}")) for n in names])
    return df.alias("rows").join(partitions.alias("parts"), on, how)


def logged_write(df: DataFrame, path: str, log_path: str, name: str, details: str = "") -> None:
    """Append a batch and then one run-log row with the number of rows written, counted during the write."""
    rows = Observation(name)
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    run_log(df.sparkSession, log_path, name, "success", details, rows.get["n"])


def run_log(spark: SparkSession, log_path: str, name: str, status: str, details: str, rows: int) -> None:
    entry = spark.range(1).select(
        F.expr("uuid()").alias("run_id"),
        F.lit(name).alias("pipeline_name"),
        F.lit(status).alias("status"),
        F.lit(details).alias("details"),
        F.lit(rows).cast("long").alias("rows_written"),
        F.current_timestamp().alias("created_at"),
    )
    entry.write.mode("append").parquet(log_path)
