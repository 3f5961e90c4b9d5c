"""Quality rules: a hashed n-gram log-likelihood ratio between trusted texts and the raw corpus, and plain counts.

Every text is cut into byte n-grams, hashed to a fixed number of buckets. Two multinomials over the buckets are counted,
one from trusted documents, one from all documents; a text's score is the mean log ratio of its n-grams. Counts
are summed within each task before they leave it, so that neither documents nor n-grams are shuffled.

Defined cases: a null text has no words and score 0; a text shorter than an n-gram scores 0; repeated rows are
scored each for itself; without trusted documents all ratios are 0 and only the plain rules decide; a null id is never
trusted; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import Hashes, binaries, numbers, rolled, sliced

NGRAM = 2
BUCKET_BITS = 12
SLICES = 16
TRUSTED_ROWS = 20_000  # at most so many labelled rows make the trusted multinomial
FLOOR = -0.7  # mean log ratio below which a text is rejected; held-out trusted texts stay above -0.35, junk is below -1.1
LEAST_WORDS = 10
REPEAT_WINDOW = 5
MOST_REPEATED = 20  # per cent of the words
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
FLUSH = 1 << 21

COLUMNS = (
    "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, score double, "
    "base_failed boolean, kept boolean"
)


def buckets(text: bytes, n: int = NGRAM, bits: int = BUCKET_BITS) -> np.ndarray:
    """The bucket of each byte n-gram."""
    a = np.frombuffer(text, np.uint8).astype(np.uint32)
    h = np.zeros(max(len(a) - n + 1, 0), np.uint32)
    for i in range(n if len(h) else 0):
        h = h * np.uint32(0x01000193) + a[i : i + len(h)]
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)


def trusted_ids(labels: DataFrame, most: int = TRUSTED_ROWS) -> np.ndarray:
    """Ids of trusted documents: those labelled 1; of more than ``most`` those with the least id hashes, so that the
    array which travels to the executors is bounded."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("id"))
    rows = good.distinct().orderBy(F.xxhash64("id"), "id").limit(most).collect()
    return np.sort(np.array([r.id for r in rows], np.int64))


def counts(documents: DataFrame, trusted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of all documents and of the trusted ones, how many n-grams fall into each bucket. Tasks send ``SLICES`` rows each; the
    driver gets one row per slice."""
    size = 1 << BUCKET_BITS
    part = size // SLICES

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, size), np.int64)
        for batch in sliced(batches):
            good = np.isin(numbers(batch["id"], 0), trusted) & batch["id"].is_valid().to_numpy(zero_copy_only=False)
            waiting: list[list[np.ndarray]] = [[], []]
            texts = binaries(batch["text"])
            held = 0
            for i, text in enumerate(texts):
                waiting[int(good[i])].append(buckets(text))
                held += len(text)
                if held > FLUSH or i == len(texts) - 1:
                    for k in (0, 1):
                        if waiting[k]:
                            total[k] += np.bincount(np.concatenate(waiting[k]), minlength=size)
                    waiting, held = [[], []], 0
        total[0] += total[1]
        cut = total.reshape(2, SLICES, part)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(SLICES), pa.int32()),
                pa.array([x.tobytes() for x in cut[0]], pa.binary()),
                pa.array([x.tobytes() for x in cut[1]], pa.binary()),
            ],
            ["slice", "raw", "target"],
        )

    def add(slices: pa.Table) -> pa.Table:
        sums = [
            np.sum([np.frombuffer(b, np.int64) for b in slices[c].to_pylist()], axis=0).tobytes()
            for c in ("raw", "target")
        ]
        return pa.table([slices["slice"][:1], pa.array([sums[0]]), pa.array([sums[1]])], ["slice", "raw", "target"])

    shape = "slice int, raw binary, target binary"
    rows = documents.mapInArrow(count, shape).groupBy("slice").applyInArrow(add, shape).collect()
    raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in rows:
        raw[r["slice"] * part : (r["slice"] + 1) * part] = np.frombuffer(r["raw"], np.int64)
        target[r["slice"] * part : (r["slice"] + 1) * part] = np.frombuffer(r["target"], np.int64)
    return raw, target


def ratios(raw: np.ndarray, target: np.ndarray, prior: float = 0.5) -> np.ndarray:
    """Log ratio of each bucket, smoothed; zeros where nothing is trusted."""
    if not target.sum():
        return np.zeros(len(raw))
    share = [np.log((c + prior) / (c.sum() + prior * len(c))) for c in (target, raw)]
    return share[0] - share[1]


def repeated_words(hashes: np.ndarray, n: int = REPEAT_WINDOW) -> int:
    """Words in windows of n words that occur more than once."""
    windows = rolled(hashes, n)
    if len(windows) < 2:
        return 0
    _, where, times = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(len(hashes) + 1, np.int64)
    starts = np.flatnonzero(times[where] > 1)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def measures(text: bytes, memo: Hashes) -> tuple[int, int, int, int, int]:
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    dense = np.frombuffer(text.translate(None, SPACE), np.uint8)
    return (
        len(words),
        int(np.count_nonzero((dense & 0xC0) != 0x80)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(memo.of(words)),
    )


def judged(values: list[bytes], weight: np.ndarray, floor: float, memo: Hashes) -> tuple[np.ndarray, ...]:
    """Counts, scores, and the verdicts of the plain rules and of both."""
    out, scores = [], []
    for value in values:
        out.append(measures(value, memo))
        h = buckets(value)
        scores.append(float(weight[h].mean(dtype=np.float64)) if len(h) else 0.0)
    n = np.array(out, np.int64).reshape(-1, 5)
    failed = (n[:, 0] < LEAST_WORDS) | (100 * n[:, 4] > MOST_REPEATED * n[:, 0])
    score = np.array(scores, np.float64)
    return n, score, failed, ~failed & (score >= floor)


def weights(documents: DataFrame, labels: DataFrame, doc_id: str, text: str) -> np.ndarray:
    rows = documents.select(documents[doc_id].cast("long").alias("id"), documents[text].cast("string").alias("text"))
    return ratios(*counts(rows, trusted_ids(labels))).astype(np.float32)


def quality(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", floor: float = FLOOR
) -> DataFrame:
    """One row per document: (id, counts, score, base_failed, kept)."""
    weight = weights(documents, labels, doc_id, text)
    rows = documents.select(documents[doc_id].cast("long").alias("id"), documents[text].cast("string").alias("text"))

    def judge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hashes()
        for batch in sliced(batches):
            n, score, failed, kept = judged(binaries(batch["text"]), weight, floor, memo)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], *map(pa.array, n.T), pa.array(score), pa.array(failed), pa.array(kept)],
                [c.split()[0] for c in COLUMNS.split(", ")],
            )

    return rows.mapInArrow(judge, COLUMNS)


def passing(
    documents: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", floor: float = FLOOR
) -> DataFrame:
    """The documents that are kept, with all their columns."""
    weight = weights(documents, labels, doc_id, text)

    def choose(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hashes()
        for batch in sliced(batches):
            yield batch.filter(pa.array(judged(binaries(batch[text]), weight, floor, memo)[3]))

    return documents.mapInArrow(choose, documents.schema)
