"""A corpus pipeline: quality rules, near copies, repeated passages, benchmark leaks, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last return the columns of
``documents``. Rejected documents go; of near copies the one of least id stays; a document loses passages that an earlier one
has, and goes if nothing is left; documents that hold a benchmark passage go; the last stage encodes what remains.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leaguelake.llm.bpe import encode, read_definition
from leaguelake.llm.common import null_safe, table
from leaguelake.llm.jaccard import representatives
from leaguelake.llm.substring import repeats
from leaguelake.llm.target_ratio import passing
from leaguelake.llm.winnowing import KEY, contamination
from leaguelake.session import stored

WORDS, PERCENT = 5, 80  # n-grams and similarity of near copies


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return passing(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return representatives(docs, n=WORDS, percent=PERCENT)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = repeats(docs, carry=[c for c in docs.columns if c != "text"])
    changed = F.size("removed") > 0
    text = F.when(changed, F.col("kept")).otherwise(F.col("text"))
    left = found.where(~changed | (F.col("kept") != "")).select(text.alias("text"), "rest", changed.alias("changed"))
    size = F.when(F.col("changed"), F.length("text")).otherwise(F.col("rest.n_chars"))
    kinds = dict(docs.dtypes)
    own = {"text": F.col("text"), "n_chars": size.cast(kinds["n_chars"])}
    return left.select(*(own.get(c, F.col(f"rest.{c}")).alias(c) for c in docs.columns))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    leaks = contamination(docs, table(spark, sf_dir, "benchmark")).where("n_hit > 0").select(*KEY).distinct()
    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    return null_safe(keyed, leaks, KEY, "left_anti").select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    out = encode(docs, read_definition(path("byte_bpe_50k.json")))
    return out.select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("benchmark_leaks", benchmark_leaks),
    ("token_ids", token_ids),
]

#: No SQL expresses byte-pair merging or the ratio's hashes; tests compare the rows with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs
