"""Token ids in binary files of patched frame-of-reference blocks.

A file holds blocks of 256 ids. A block keeps its least id, the differences to it packed at the width that holds a chosen
share of them, and a list of exceptions (position and remaining high bits) for the others. The file's end indexes
where blocks start and how many ids each document has::

    magic | blocks | block starts (u64) | document ids (i64) | id is known (u8) | lengths (u64) | counts and offset | magic
    block: least (u32) | ids (u16) | exceptions (u16) | width (u8) | packed differences | positions (u8) | high bits (u32)

Defined cases: a null text has only the end id; a null document id sorts first and is read back as null; rows with
equal ids are ordered by their text's hash, then by text; an empty table makes no file.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leaguelake.llm import files
from leaguelake.llm.bpe import byte_letters, is_latin
from leaguelake.llm.common import binaries
from leaguelake.session import new_folder

MAGIC = b"PFORIDS1"
BLOCK = 256
SHARE = 0.9  # of a block's differences that fit its width
HEAD = "<IHHB"
TAIL = "<QQQ8s"
HEAD_SIZE, TAIL_SIZE = struct.calcsize(HEAD), struct.calcsize(TAIL)
BATCH = 1 << 16  # ids packed or unpacked at once
FILE_IDS = 1 << 26
MEMO = 400_000
MEMO_LENGTH = 64  # longer ones are not remembered
#: Fixed value: how the vocabulary's authors split lower-case text, for the letters and numbers of Latin-1.
PIECES = r"[a-zªµºß-öø-ÿ]+|[0-9²³¹¼-¾]|'s|'t|'re|'ve|'m|'ll|'d|[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼-¾]+"


def pack(ids: np.ndarray, share: float = SHARE) -> list[bytes]:
    """The blocks of these ids; all but the last have BLOCK ids."""
    if not len(ids):
        return []
    count = -(-len(ids) // BLOCK)
    full = np.full(count * BLOCK, ids[-1], np.uint32)
    full[: len(ids)] = ids
    full = full.reshape(count, BLOCK)
    least = full.min(axis=1)
    diff = full - least[:, None]
    width = np.full(count, 32, np.uint8)
    need = int(np.ceil(share * BLOCK))
    for w in range(int(diff.max()).bit_length(), -1, -1):
        width[np.count_nonzero(diff < (1 << w), axis=1) >= need] = w
    high = diff >> width[:, None].astype(np.uint32) if width.max() < 32 else np.zeros_like(diff)
    low = diff - (high << width[:, None].astype(np.uint32))
    packed: list[bytes] = [b""] * count
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(low[rows].astype("<u4" if w > 16 else "<u2").view(np.uint8), axis=1, bitorder="little")
        kept = bits.reshape(len(rows), BLOCK, 32 if w > 16 else 16)[:, :, :w].reshape(len(rows), -1)
        for r, b in zip(rows, np.packbits(kept, axis=1, bitorder="little"), strict=True):
            packed[r] = b.tobytes()
    where, at = np.nonzero(high)
    bounds = np.searchsorted(where, np.arange(count + 1))
    values, out = high[where, at].astype("<u4"), []
    for r in range(count):
        a, b = bounds[r], bounds[r + 1]
        n = min(BLOCK, len(ids) - r * BLOCK)
        head = struct.pack(HEAD, int(least[r]), n, b - a, int(width[r]))
        out.append(b"".join((head, packed[r], at[a:b].astype(np.uint8).tobytes(), values[a:b].tobytes())))
    return out


def unpack(data: bytes) -> np.ndarray:
    """The ids of consecutive whole blocks."""
    heads, bodies, exceptions, at = [], [], [], 0
    while at < len(data):
        head = struct.unpack_from(HEAD, data, at)
        at += HEAD_SIZE
        size = BLOCK // 8 * head[3]
        bodies.append(data[at : at + size])
        at += size
        exceptions.append((data[at : at + head[2]], data[at + head[2] : at + 5 * head[2]]))
        at += 5 * head[2]
        heads.append(head)
    out = np.zeros((len(heads), BLOCK), np.uint32)
    width = np.array([h[3] for h in heads])
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        bits = np.unpackbits(np.frombuffer(b"".join(bodies[r] for r in rows), np.uint8), bitorder="little")
        wide = np.zeros((len(rows), BLOCK, 32 if w > 16 else 16), np.uint8)
        wide[:, :, :w] = bits.reshape(len(rows), BLOCK, w)
        values = np.packbits(wide.reshape(len(rows), -1), axis=1, bitorder="little")
        out[rows] = values.view("<u4" if w > 16 else "<u2")
    for r, (positions, highs) in enumerate(exceptions):
        if positions:
            out[r, np.frombuffer(positions, np.uint8)] |= np.frombuffer(highs, "<u4") << np.uint32(width[r])
    out += np.array([h[0] for h in heads], np.uint32)[:, None]
    counts = [h[1] for h in heads]
    return np.concatenate([row[:n] for row, n in zip(out, counts, strict=True)]) if heads else np.empty(0, np.uint32)


class Writer:
    """One file: documents are appended, blocks are written as they fill."""

    def __init__(self, uri: str):
        self.uri, self.out = uri, files.create(uri)
        self.out.write(MAGIC)
        self.at, self.starts, self.waiting, self.held, self.total = len(MAGIC), [], [], 0, 0
        self.ids: list[int | None] = []
        self.lengths: list[int] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.lengths.append(len(ids))
        self.waiting.append(ids)
        self.held += len(ids)
        self.total += len(ids)
        if self.held >= BATCH:
            self.flush(self.held // BLOCK * BLOCK)

    def flush(self, count: int) -> None:
        ids = np.concatenate(self.waiting) if self.waiting else np.empty(0, np.uint32)
        for block in pack(ids[:count]):
            self.starts.append(self.at)
            self.at += len(block)
            self.out.write(block)
        self.waiting, self.held = [ids[count:]], len(ids) - count

    def close(self) -> None:
        self.flush(self.held)
        known = np.array([i is not None for i in self.ids], np.uint8)
        for a, kind in ((self.starts, "<u8"), ([i or 0 for i in self.ids], "<i8"), (known, "u1"), (self.lengths, "<u8")):
            self.out.write(np.array(a, kind).tobytes())
        self.out.write(struct.pack(TAIL, len(self.starts), len(self.ids), self.at, MAGIC))
        self.out.close()


def read_file(uri: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(document id, ids before it in the file, its ids), in the file's order."""
    with files.load(uri) as f:
        size = f.size()
        f.seek(size - TAIL_SIZE)
        blocks, docs, index, magic = struct.unpack(TAIL, f.read(TAIL_SIZE))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a file of token ids")
        f.seek(index)
        starts = [*np.frombuffer(f.read(8 * blocks), "<u8").tolist(), index]
        ids, known = np.frombuffer(f.read(8 * docs), "<i8").tolist(), f.read(docs)
        lengths = np.frombuffer(f.read(8 * docs), "<u8").tolist()
        step, block, held, before = BATCH // BLOCK, 0, np.empty(0, np.uint32), 0
        for i, doc_id in enumerate(ids):
            parts, missing = [], lengths[i]
            while missing > len(held):
                parts.append(held)
                missing -= len(held)
                end = min(block + step, blocks)
                f.seek(starts[block])
                held, block = unpack(f.read(starts[end] - starts[block])), end
            parts.append(held[:missing])
            held = held[missing:]
            yield (doc_id if known[i] else None), before, np.concatenate(parts)
            before += lengths[i]


def encode_words(definition: str):
    """A function from text to ids. Latin-1 text is split by the vocabulary's rules here, so that the library's model
    meets each lower-case piece once; of other text, the words with other letters go to the library, which may be done
    word by word since no match of the rules reaches across white space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    model = tokenizer.model
    letters = {byte: letter for letter, byte in byte_letters().items()}
    split = re.compile(PIECES)

    class Pieces(dict):
        def __missing__(self, text: str) -> bytes:
            if len(self) >= MEMO:
                self.clear()
            shown = text.encode().decode("latin-1").translate(letters)
            ids = array("I", [t.id for t in model.tokenize(shown)]).tobytes()
            if len(text) <= MEMO_LENGTH:
                self[text] = ids
            return ids

    class Words(dict):
        def __missing__(self, raw: bytes) -> bytes:
            if len(self) >= MEMO:
                self.clear()
            text = raw.decode()
            if "<|" not in text and is_latin(text):
                ids = b"".join(map(pieces.__getitem__, split.findall(text.lower())))
            else:
                ids = array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            if len(raw) <= MEMO_LENGTH:
                self[raw] = ids
            return ids

    pieces, words = Pieces(), Words()

    def encode(raw: bytes) -> bytes:
        text = raw.decode()
        if "<|" not in text and is_latin(text):
            return b"".join(map(pieces.__getitem__, split.findall(text.lower())))
        return b"".join(map(words.__getitem__, raw.split()))

    return encode


def write(documents: DataFrame, definition: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all documents in ascending order of their id, a task's share to one file or more. Returns
    (shard, file, uri, n_docs, n_ids), whose order is that of the ids."""
    spark = documents.sparkSession
    folder = new_folder(spark, "token-files")
    rows = documents.select(documents[doc_id].cast("long").alias("id"), documents[text].cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order, F.col("text").asc_nulls_first())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encode_words(definition), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        writer, done = None, []
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                for key, text in zip(part["id"].to_pylist(), binaries(part["text"]), strict=True):
                    writer = writer or Writer(files.own_name(folder, f"{shard:06d}-{len(done):04d}", ".ids"))
                    writer.add(key, np.frombuffer(encode(text) + end, "<u4"))
                    if writer.total >= FILE_IDS:
                        writer.close()
                        done.append(writer)
                        writer = None
        if writer:
            writer.close()
            done.append(writer)
        columns = [[shard] * len(done), range(len(done)), [w.uri for w in done], [len(w.ids) for w in done], [w.total for w in done]]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["shard", "file", "uri", "n_docs", "n_ids"]
        )

    return files.committed(rows.mapInArrow(run, "shard long, file long, uri string, n_docs long, n_ids long"), "token-file-list")


def read(spark: SparkSession, written: DataFrame) -> DataFrame:
    """(id, start, ids): what the files hold; start counts the ids of all documents before, ids are little-endian
    unsigned 32-bit integers. The window below has a row per file."""
    before = Window.orderBy("shard", "file").rowsBetween(Window.unboundedPreceding, -1)
    placed = written.select("uri", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("offset"))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["id", "start", "ids"]
            )

        for listed in batches:
            for uri, offset in zip(listed["uri"].to_pylist(), listed["offset"].to_pylist(), strict=True):
                rows, size = [], 0
                for key, start, ids in read_file(uri):
                    rows.append((key, offset + start, ids.astype("<u4").tobytes()))
                    size += 4 * len(ids)
                    if size > 1 << 22:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    return placed.repartition(tasks, "uri").mapInArrow(run, "id long, start long, ids binary")
