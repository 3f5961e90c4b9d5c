"""Words, hashes, and exchanges between chunks of documents and slots of keys.

Several operators must ask a table that grows with the corpus about every n-gram of every document. They share one
plan. Documents are dealt to *chunks* by a hash of their id and text. A chunk sends each distinct key once, packed with the
others of the same *slot* (a range of key hashes); a slot answers its chunks. A key that a third of all rows hold thus
arrives once per chunk, whatever its count. Chunks and slots are as many as the shuffle partitions, so that their
size follows the setting which already sizes tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MEMO = 1 << 18  # entries that a task's table of known words may hold before it starts anew
MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows, a few at a time, so that not all texts of a batch become Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


class Hashes(dict):
    """64-bit hashes of words, kept for those seen lately."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Another hash of each hash."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def rolled(h: np.ndarray, n: int, multiplier: np.uint64 = MULTIPLIERS[0]) -> np.ndarray:
    """A hash of each window of n consecutive entries; none if there are fewer."""
    count = len(h) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    acc = h[:count].copy()
    for i in range(1, n):
        acc *= multiplier
        acc += h[i : i + count]
    return acc


def binaries(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 of each text; of null, nothing."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def numbers(column: pa.ChunkedArray, null: int) -> np.ndarray:
    return np.asarray(column.fill_null(null).to_numpy(), dtype=np.int64)


def planes(a: np.ndarray) -> bytes:
    """First bytes of all entries, then second bytes, and so on: like bytes side by side compress in the shuffle."""
    a = np.ascontiguousarray(a)
    return a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def unplanes(b: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def slot_of(keys: np.ndarray, slots: int) -> np.ndarray:
    """Slots are ranges of keys: sorted keys have sorted slots."""
    return ((keys >> np.uint64(40)) * np.uint64(slots) >> np.uint64(24)).astype(np.int64)


def by_slot(chunk: int, slots: int, keys: np.ndarray, *columns: np.ndarray, names: list[str]) -> pa.Table:
    """A row for each slot that any of the sorted keys belong to."""
    slot = slot_of(keys, slots)
    starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.empty(0, np.int64)
    ends = np.r_[starts[1:], len(slot)] if len(slot) else starts
    packed = [[planes(c[a:b]) for a, b in zip(starts, ends, strict=True)] for c in (keys, *columns)]
    arrays = [pa.array(slot[starts], pa.int64()), pa.array([chunk] * len(starts), pa.int64())]
    return pa.table([*arrays, *(pa.array(p, pa.binary()) for p in packed)], ["slot", "chunk", *names])


def gathered(table: pa.Table, name: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All entries of a packed column, and the row each came from."""
    parts = [unplanes(b, dtype) for b in table[name].to_pylist()]
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    return (np.concatenate(parts) if parts else np.empty(0, dtype)), rows


def groups(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal entries starts."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)


def found(wanted: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Position of each wanted value in a sorted array, or -1."""
    if not len(among):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(among, wanted), len(among) - 1)
    return np.where(among[at] == wanted, at, -1)


class Lookup:
    """Positions of values in a sorted array, or -1. A table of the values' top bits keeps most absent ones from being searched."""

    BITS = np.uint64(22)

    def __init__(self, among: np.ndarray):
        self.among, self.marks = among, np.zeros(1 << int(self.BITS), bool)
        self.marks[among >> (np.uint64(64) - self.BITS)] = True

    def of(self, wanted: np.ndarray) -> np.ndarray:
        out = np.full(len(wanted), -1)
        maybe = np.flatnonzero(self.marks[wanted >> (np.uint64(64) - self.BITS)])
        out[maybe] = found(wanted[maybe], self.among)
        return out


def spread(spark: SparkSession) -> int:
    """Chunks, and slots."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunked(rows: DataFrame, doc_id: str, text: str, carry: list[str] | None = None) -> DataFrame:
    """(chunk, id, text, rest): which chunk follows from the row alone, so a repeated task deals alike."""
    key, value = rows[doc_id].cast("long"), rows[text].cast("string")
    chunk = F.pmod(F.xxhash64(key, value), F.lit(spread(rows.sparkSession)))
    rest = [F.struct(*(rows[c] for c in carry)).alias("rest")] if carry else []
    return rows.select(chunk.alias("chunk"), key.alias("id"), value.alias("text"), *rest)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1024) -> Iterator[None]:
    """While this lasts, Python gets and gives so many rows at a time: a batch of long rows is held by both sides."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def null_safe(left: DataFrame, right: DataFrame, names: list[str], how: str = "left") -> DataFrame:
    """Join on equal names, null equal to null; the right side's key columns go."""
    renamed = right.withColumnsRenamed({n: f"__{n}" for n in names})
    on: Column = F.lit(True)
    for n in names:
        on = on & left[n].eqNullSafe(renamed[f"__{n}"])
    return left.join(renamed, on, how).drop(*(f"__{n}" for n in names))
