"""A stream over several micro-batches must end with the batch result."""

import re

import pytest
from pyspark.sql import functions as F

from leaguelake.operators.events import event_counts
from leaguelake.operators.history import latest_per_key
from leaguelake.plans.adapters import ADAPTERS, load
from leaguelake.session import new_folder
from leaguelake.streaming import live as L

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def landed(spark):
    path = new_folder(spark, "test-landed")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    events.repartitionByRange(3, "ts").write.parquet(path)
    return path, events.schema


def stream(spark, landed):
    path, schema = landed
    columns = ADAPTERS["match_events"][1]
    source = L.read_folder(spark, path, schema, "*.parquet", per_batch=1)
    return source.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()])


def run(spark, df, mode="update"):
    path = new_folder(spark, "test-stream")
    L.run_to_table(df, path, new_folder(spark, "test-stream-checkpoint"), mode)
    return path


def same(left, right):
    columns = right.columns
    assert sorted(map(repr, left.select(columns).collect())) == sorted(map(repr, right.collect()))


def landed_in(spark, rows, path, files):
    for f in files:
        rows.filter(F.pmod(F.xxhash64("event_id"), F.lit(8)) == f).coalesce(1).write.mode("append").parquet(path)


def adapted(df):
    return df.selectExpr(*[f"{e} AS {n}" for n, e in ADAPTERS["match_events"][1].items()])


@pytest.mark.parametrize("value, batch", [
    (L.COUNTS_BY_TYPE, lambda e: event_counts(e, "match_id", "event_type")),
    (L.latest(["match_id"], ["-ts", "-event_id"]), lambda e: latest_per_key(e, ["match_id"], ["-ts", "-event_id"])),
])
def test_running_values_over_restarts(spark, value, batch):
    """Eight shuffled files, two restarts: after each run the value is that of the rows so far; reading touches the current table
    and the epochs since, and merged parts go."""
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet")
    path, folder, checkpoint = (new_folder(spark, f"test-{n}") for n in ("running", "landed-files", "checkpoint"))
    for files in ((0, 1, 2), (3, 4, 5, 6), (7,)):
        landed_in(spark, rows, folder, files)
        source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        L.run_running(adapted(source), path, checkpoint, value, every=2)
        now = L.running_value(spark, path, value)
        same(now, batch(adapted(spark.read.parquet(folder))))
    assert L.compacted_until(spark, path) == [5, 3, 1]
    read = {m[0] for f in now.inputFiles() if (m := re.search(r"current/until=\d+", f))}
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert read == {"current/until=5"} and re.search(r"PartitionFilters: \[[^]]*epoch#\d+ > 5", plan)
    left = {re.search(r"epochs/epoch=(\d+)", f)[1] for f in spark.read.parquet(f"{path}/epochs").inputFiles()}
    assert left == {"4", "5", "6", "7"}
    before = sorted(map(repr, now.collect()))
    L.compact(spark, path, value, 7)
    L.compact(spark, path, value, 7)  # a repeated call changes nothing
    assert sorted(map(repr, L.running_value(spark, path, value).collect())) == before


def test_lost_compaction_is_not_read(spark):
    """A current table that was written but not noted does not count."""
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet")
    path, folder = new_folder(spark, "test-running"), new_folder(spark, "test-landed-files")
    landed_in(spark, rows, folder, range(4))
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    L.run_running(adapted(source), path, new_folder(spark, "test-checkpoint"), L.COUNTS_BY_TYPE, every=100)
    wrong = L.running_value(spark, path, L.COUNTS_BY_TYPE).withColumn("n", F.col("n") * 2)
    wrong.write.parquet(f"{path}/current/until=2")
    same(L.running_value(spark, path, L.COUNTS_BY_TYPE), event_counts(adapted(spark.read.parquet(folder)), "match_id", "event_type"))


def test_feed(spark, landed):
    path = new_folder(spark, "test-feed")
    rows = stream(spark, landed).select("event_id", "ts")
    L.run_feed(rows, path, new_folder(spark, "test-feed-checkpoint"), ["-ts", "-event_id"], n=20)
    batch = load(spark, SF_DIR, "match_events").select("event_id", "ts")
    same(L.last_epoch(spark, path), batch.orderBy(F.desc("ts"), F.desc("event_id")).limit(20))


def test_closed_windows(spark, landed):
    """In append mode only windows behind the watermark are reported, each once and complete."""
    path, schema = landed
    source = L.read_folder(spark, path, schema, "*.parquet", per_batch=1)
    out = L.all_epochs(spark, run(spark, L.events_per_second(source, late="1 hour"), "append"))
    whole = L.events_per_second(spark.read.parquet(path))
    assert out.count() == out.select("second_start").distinct().count() > 0
    assert out.exceptAll(whole).isEmpty()


def test_a_landing_is_dealt_by_one_pass(spark, tmp_path, monkeypatch):
    """Each of the three landings is one job that writes all its files, not one for each file."""
    import glob

    from leaguelake.queries import streaming

    rows = spark.range(2000).selectExpr("id", "id % 50 AS k")
    rows.write.parquet(f"{tmp_path}/given.parquet")
    monkeypatch.setattr(streaming, "new_folder", lambda spark, name: f"{tmp_path}/{name}")
    out = streaming.run_restarted(spark, str(tmp_path), "given", ["id", "k"], L.latest(["k"], ["-id"]), "id")
    assert {(r.k, r.id) for r in out.collect()} == {(k, 1950 + k) for k in range(50)}
    assert spark.read.parquet(f"{tmp_path}/landed").count() == 2000
    written = {p.rpartition("/")[2].split("-", 2)[2].rpartition("-c")[0] for p in glob.glob(f"{tmp_path}/landed/part-*")}
    assert len(written) == 3 and len(glob.glob(f"{tmp_path}/landed/part-*")) == 8 * streaming.WRITERS
