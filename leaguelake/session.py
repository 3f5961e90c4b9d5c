"""Session defaults for tests and the benchmark, and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_TEMPORARY: ContextVar[list[str] | None] = ContextVar("temporary", default=None)


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session; on a cluster the caller passes its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("leaguelake")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.streaming.metricsEnabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one only where that is unset (tests)."""
    configured = spark.sparkContext.getConf().get(CHECKPOINT_DIR) or spark.conf.get(CHECKPOINT_DIR, None)
    if not configured:
        configured = spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_DIR} must name a folder that all machines share")
        configured = tempfile.mkdtemp(prefix="leaguelake-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that are ``stored`` meanwhile are deleted at the end, but for those to keep: a result that is read later must be kept."""
    paths: list[str] = []
    token = _TEMPORARY.set(paths)
    try:
        yield
    finally:
        _TEMPORARY.reset(token)
        for path in paths:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Compute a table once, write it to the shared folder and read it back: its lineage ends there."""
    path = new_folder(df.sparkSession, name)
    if not keep and (paths := _TEMPORARY.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
