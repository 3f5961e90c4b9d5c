"""Language-model scores from a weighted backoff automaton.

The model is a smoothed bigram model of the training documents. Its states are the words that occur in them, the beginning
of a text, and a root that knows no context. A pair that occurs is an arc from its first word's state, with the weight
log((c(hw) + MU p(w)) / (c(h) + MU)); any other word leaves a known state by its failure arc, log(MU / (c(h) + MU)), to the
root, whose arcs are log p(w), p(w) = (c(w) + 1) / (N + V + 1). A text is read once from left to right: each token moves
to its own state if that is known, else to the root.

Counts grow with the corpus and are never gathered whole: a chunk of documents (see ``common``) sends each distinct word
and pair once with its training count, a slot adds them up and answers in the order asked, and the chunk walks its texts
along the states and arcs that the answers describe.

Defined cases: null and empty texts are one end token; a null id counts as the empty text when training documents are chosen;
repeated rows count and are scored each; without training documents every token has probability 1; an empty table gives an empty
result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.common import (
    MULTIPLIERS,
    Hashes,
    binaries,
    by_slot,
    chunked,
    gathered,
    groups,
    mixed,
    planes,
    spread,
    unplanes,
)

MU = 4.0  # how many tokens' worth of the root's distribution a state mixes in
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
WORD, PAIR = 1, 2
STEP = 1 << 18  # tokens walked at once
COLUMNS = (
    "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def held_out(doc_id: int | None, parts: int = 7, part: int = 2) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % parts == part


def token_hashes(text: bytes, memo: Hashes) -> np.ndarray:
    """The words and the end, in lower case (A-Z only)."""
    return np.append(memo.of(text.lower().split()), END)


def pair_hashes(h: np.ndarray) -> np.ndarray:
    """Each token together with the one before."""
    return mixed(np.append(START, h[:-1])) * MULTIPLIERS[1] + h


def distinct(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, weights = keys[order], weights[order]
    first = groups(keys)
    return keys[first], (np.add.reduceat(weights, first) if len(first) else weights).astype(np.uint32)


class Chunk:
    """The tokens of a chunk's documents, one after the other, and their distinct words and pairs with training counts."""

    def __init__(self, table: pa.Table):
        memo, ids = Hashes(), table["id"].to_pylist()
        each = [token_hashes(t, memo) for t in binaries(table["text"])]
        self.held = np.array([held_out(i) for i in ids], bool)
        self.sizes = np.array([len(x) for x in each], np.int64)
        self.tokens = np.concatenate(each)
        self.pairs = np.concatenate([pair_hashes(x) for x in each])
        training = np.repeat(~self.held, self.sizes).astype(np.int64)
        self.keys = {WORD: distinct(self.tokens, training), PAIR: distinct(self.pairs, training)}


    def parts(self) -> list[tuple[int, int]]:
        """Ranges of texts of about STEP tokens."""
        step = np.cumsum(self.sizes) // STEP
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1), len(self.sizes)]
        return list(zip(cuts[:-1], cuts[1:], strict=True))


class Automaton:
    """Counts of a chunk's words and pairs as states and arcs."""

    def __init__(self, words: np.ndarray, word_counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray, tokens: int, types: int):
        self.words, self.word_counts, self.pairs, self.pair_counts = words, word_counts, pairs, pair_counts
        self.tokens, self.types = tokens, types

    def walk(self, h: np.ndarray, pairs: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token: whether it is known, its weight at the root, and the weight of the arcs taken. texts says where
        texts begin."""
        count = self.word_counts[np.searchsorted(self.words, h)].astype(np.float64)
        root = np.log10(count + 1) - np.log10(self.tokens + self.types + 1)
        state = np.append(0.0, count[:-1])  # how often the state carried from the token before was met; 0: the root
        ends = self.word_counts[np.searchsorted(self.words, np.array([END]))][0] if len(self.words) else 0
        state[texts] = ends  # every text has one beginning and one end
        arc = self.pair_counts[np.searchsorted(self.pairs, pairs)].astype(np.float64)
        taken = np.log10(arc + MU * 10**root) - np.log10(state + MU)
        failed = np.log10(MU) - np.log10(state + MU) + root
        return count > 0, root, np.where(state == 0, root, np.where(arc > 0, taken, failed))


def scores(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, see COLUMNS."""
    slots = spread(documents.sparkSession)
    rows = chunked(documents, doc_id, text)

    def walked(automaton: Automaton, chunk: Chunk, first: int, last: int) -> list[np.ndarray]:
        """Sums over each of some consecutive texts."""
        ends = np.cumsum(chunk.sizes)
        a, b = ends[first] - chunk.sizes[first], ends[last - 1]
        begins = ends[first:last] - chunk.sizes[first:last] - a
        known, root, weight = automaton.walk(chunk.tokens[a:b], chunk.pairs[a:b], begins)
        return [np.add.reduceat(x, begins) for x in (known.astype(np.int64), root, weight)]

    def ask(key: tuple, table: pa.Table) -> pa.Table:
        parts = []
        for kind, (keys, counts) in Chunk(table).keys.items():
            part = by_slot(key[0].as_py(), slots, keys, counts, names=["keys", "counts"])
            parts.append(part.append_column("kind", pa.array([kind] * part.num_rows, pa.int64())))
        return pa.concat_tables(parts)

    def add(key: tuple, table: pa.Table) -> pa.Table:
        out = []
        for kind in (WORD, PAIR):
            part = table.filter(pc.equal(table["kind"], kind))
            (keys, row), (counts, _) = gathered(part, "keys", np.uint64), gathered(part, "counts", np.uint32)
            known, place = np.unique(keys, return_inverse=True)
            total = np.bincount(place, counts, len(known)).astype(np.uint64)[place].astype(np.uint64)
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            packed = [planes(total[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            kinds = pa.array([kind] * part.num_rows, pa.int64())
            out.append(pa.table([part["chunk"], part["slot"], kinds, pa.array(packed, pa.binary())], ["chunk", "slot", "kind", "counts"]))
        return pa.concat_tables([t.cast(out[0].schema) for t in out])

    def size(table: pa.Table) -> pa.Table:
        part = table.filter(pc.equal(table["kind"], WORD))
        (keys, _), (counts, _) = gathered(part, "keys", np.uint64), gathered(part, "counts", np.uint32)
        return pa.table({"tokens": [int(counts.sum())], "types": [len(np.unique(keys[counts > 0]))]})

    def score(key: tuple, table: pa.Table, answer: pa.Table) -> pa.Table:
        chunk, answer = Chunk(table), answer.sort_by([("kind", "ascending"), ("slot", "ascending")])
        counts = {}
        for kind in (WORD, PAIR):
            part = answer.filter(pc.equal(answer["kind"], kind))
            counts[kind] = np.concatenate([unplanes(b, np.uint64) for b in part["counts"].to_pylist()])
        tokens, types = (answer[c][0].as_py() for c in ("tokens", "types"))
        automaton = Automaton(chunk.keys[WORD][0], counts[WORD], chunk.keys[PAIR][0], counts[PAIR], tokens, types)
        sums = [np.concatenate(x) for x in zip(*(walked(automaton, chunk, a, b) for a, b in chunk.parts()), strict=True)]
        columns = [table["id"], pa.array(chunk.held), pa.array(chunk.sizes), pa.array(sums[0]), pa.array([tokens] * table.num_rows, pa.int64())]
        return pa.table([*columns, pa.array(sums[1]), pa.array(sums[2])], [c.split()[0] for c in COLUMNS.split(", ")])

    asked = rows.groupBy("chunk").applyInArrow(ask, "slot long, chunk long, keys binary, counts binary, kind long")
    total = asked.groupBy("slot").applyInArrow(size, "tokens long, types long")
    sizes = total.agg(F.struct(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).alias("sizes")).scalar()
    answers = asked.groupBy("slot").applyInArrow(add, "chunk long, slot long, kind long, counts binary")
    told = answers.withColumn("sizes", sizes).select("chunk", "slot", "kind", "counts", F.col("sizes.col1").alias("tokens"), F.col("sizes.col2").alias("types"))
    return rows.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, COLUMNS)
