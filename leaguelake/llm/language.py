"""Language identification: a linear-chain conditional random field labels the words of a text, also where it switches languages.

A word's emission is the sum of weights of its byte n-grams (those at its edges are prefixes and suffixes, marked by a border byte),
and of the lexicon that lists it, if any. Transitions between the labels of neighbouring words are learned with them, by
gradients from forward-backward over sequences in which pieces of texts of several languages follow each other. A text's
language is the label with the greatest sum of word marginals, its score the mean marginal.

Texts are labelled exactly and whole: they are cut into blocks of words, the blocks' transfer matrices carry messages over
block borders, and marginals are then computed in all blocks at once. The classifier is fitted in one task on a sample that
is bounded by ``ROWS`` texts a language and ``PIECES`` pieces of ``PIECE`` words a text, spread over the whole text.

Defined cases: a text without letters, or null, is ``und`` with score 0; without training texts all texts are; equal sums go to the
label that sorts first; a null id counts as the empty text when training texts are chosen; repeated rows are answered each for
itself; a single label gets score 1; an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.llm.common import sliced

ROWS = 250  # texts of each language in the sample
PIECE, PIECES = 12, 24  # words a piece, pieces a text
SEQUENCE = 4  # pieces that follow each other in a training sequence
SAME = 0.6  # how often a piece is followed by one of the same language
LENGTHS = (1, 2, 3, 4)  # bytes of n-grams
BITS = 15
LISTED = 5  # times that a word of a lexicon occurs in the sample
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.25, 1e-6
BLOCK = 32  # words
STEP = 1 << 17  # words labelled at once
MEMO = 1 << 18  # words whose emissions a task keeps
SLICE = 1 << 20  # characters cut into words at once
WORD = re.compile(r"[^\W\d_]+")
BORDER = 0x1F
UNKNOWN = "und"
COLUMNS = "doc_id long, held_out boolean, lang_pred string, score double"


def words_of(text: str) -> Iterator[list[str]]:
    """The words in lower case, some at a time; a slice ends where a word does."""
    start = 0
    while start < len(text):
        end = start + SLICE
        while end < len(text) and not text[end].isspace():
            end += 1
        yield WORD.findall(text[start:end].lower())
        start = end


def grams(words: list[str], lengths: tuple[int, ...] = LENGTHS, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all words, word by word for each length, and how many there are before each word."""
    border = bytes([BORDER])
    parts = [border + w.encode("utf-8", "replace") + border for w in words]
    size = np.array([len(p) for p in parts], np.int64)
    text = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
    word = np.repeat(np.arange(len(parts)), size)
    keys, owners = [], []
    for n in lengths:
        count = len(text) - n + 1
        if count <= 0:
            continue
        h = np.full(count, n, np.uint32)
        for i in range(n):
            h = h * np.uint32(0x01000193) ^ text[i : i + count]
        whole = word[:count] == word[n - 1 :]  # not across two words
        keys.append((h[whole] * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits))
        owners.append(word[:count][whole])
    key, owner = np.concatenate(keys), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return key[order].astype(np.int64), np.searchsorted(owner[order], np.arange(len(parts)))


class Model:
    """Labels, weights of n-grams and lexicons, transitions."""

    def __init__(self, labels: list[str], lexicon: dict[str, int]):
        n = len(labels)
        self.labels, self.lexicon = labels, lexicon
        self.weights = np.zeros((1 << BITS, n), np.float32)
        self.listed = np.zeros((n + 1, n), np.float32)  # the last row is for words in no lexicon
        self.moves = np.zeros((n, n), np.float32)

    def lexicons(self, words: list[str]) -> np.ndarray:
        none = len(self.labels)
        return np.array([self.lexicon.get(w, none) for w in words], np.int64)

    def emissions(self, words: list[str]) -> np.ndarray:
        keys, starts = grams(words)
        out = np.add.reduceat(self.weights[keys], starts, axis=0)
        return out + self.listed[self.lexicons(words)]


def marginals(emissions: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sequences (time, sequence, label): label marginals, and the sums of marginals of neighbouring pairs."""
    steps, count, n = emissions.shape
    e = np.exp(emissions - emissions.max(axis=2, keepdims=True))
    move = np.exp(moves)
    ahead, back = np.empty_like(e), np.empty_like(e)
    ahead[0] = e[0] / e[0].sum(axis=1, keepdims=True)
    for t in range(1, steps):
        x = (ahead[t - 1] @ move) * e[t]
        ahead[t] = x / x.sum(axis=1, keepdims=True)
    back[-1] = 1.0 / n
    for t in range(steps - 2, -1, -1):
        x = (e[t + 1] * back[t + 1]) @ move.T
        back[t] = x / x.sum(axis=1, keepdims=True)
    each = ahead * back
    each /= each.sum(axis=2, keepdims=True)
    pairs = np.zeros((n, n))
    if steps > 1:
        after = (e[1:] * back[1:]).reshape(-1, n)
        before = ahead[:-1].reshape(-1, n)
        total = np.einsum("xi,ij,xj->x", before, move, after, optimize=True)
        pairs = np.einsum("xi,xj,x->ij", before, after, 1 / total, optimize=True) * move
    return each, pairs


def trained(pieces: list[tuple[str, list[str]]]) -> Model | None:
    """A model from pieces of single-language texts, which are chained to sequences that switch between languages."""
    if not pieces:
        return None
    pieces = sorted(pieces)
    labels = sorted({lang for lang, _ in pieces})
    number = {lang: i for i, lang in enumerate(labels)}
    counts: dict[str, Counter] = {}
    for lang, words in pieces:
        for w in words:
            counts.setdefault(w, Counter())[number[lang]] += 1
    kinds = sorted(counts)
    lexicon = {}
    for w in kinds:
        best, times = max(counts[w].items(), key=lambda x: (x[1], -x[0]))
        if times >= LISTED and times > 0.8 * counts[w].total():
            lexicon[w] = best
    model, n = Model(labels, lexicon), len(labels)
    if n == 1:
        return model
    place = {w: i for i, w in enumerate(kinds)}
    keys, starts = grams(kinds)
    ends = np.append(starts[1:], len(keys))
    lists = model.lexicons(kinds)
    full = [(number[lang], [place[w] for w in words]) for lang, words in pieces if len(words) == PIECE]
    if not full:  # only short texts: each is repeated up to the length of a piece
        full = [(number[lang], [place[words[i % len(words)]] for i in range(PIECE)]) for lang, words in pieces]
    of_label = [np.array([i for i, (y, _) in enumerate(full) if y == k]) for k in range(n)]
    of_label = [x for x in of_label if len(x)]
    tokens = np.array([w for _, w in full])
    truth = np.array([y for y, _ in full])
    draw = np.random.default_rng(7)
    squares = [np.full_like(x, 1e-6) for x in (model.weights, model.listed, model.moves)]
    sequences = max(len(full) // SEQUENCE, BATCH)
    for _ in range(EPOCHS):
        for _ in range(-(-sequences // BATCH)):
            rows = np.empty((BATCH, SEQUENCE), np.int64)
            rank = draw.integers(len(of_label), size=BATCH)
            for s in range(SEQUENCE):
                if s:
                    switch = draw.random(BATCH) > SAME
                    rank = np.where(switch, draw.integers(len(of_label), size=BATCH), rank)
                rows[:, s] = [of_label[k][draw.integers(len(of_label[k]))] for k in rank]
            word = tokens[rows].reshape(BATCH, -1).T  # (time, sequence)
            label = np.repeat(truth[rows], PIECE, axis=1).T
            used, where = np.unique(word, return_inverse=True)
            where = where.reshape(word.shape)
            own = np.concatenate([keys[starts[w] : ends[w]] for w in used])
            first = np.cumsum(np.r_[0, (ends - starts)[used]])
            shown = np.add.reduceat(model.weights[own], first[:-1], axis=0) + model.listed[lists[used]]
            each, pairs = marginals(shown[where].astype(np.float64), model.moves.astype(np.float64))
            wrong = each.copy()
            np.put_along_axis(wrong, label[..., None], np.take_along_axis(wrong, label[..., None], 2) - 1, axis=2)
            by_word = np.zeros((len(used), n))
            np.add.at(by_word, where.reshape(-1), wrong.reshape(-1, n))
            by_key = np.repeat(by_word, np.diff(first), axis=0)
            gradient = np.stack([np.bincount(own, by_key[:, k], 1 << BITS) for k in range(n)], axis=1)
            listed = np.stack([np.bincount(lists[used], by_word[:, k], n + 1) for k in range(n)], axis=1)
            seen = np.zeros((n, n))
            np.add.at(seen, (label[:-1].reshape(-1), label[1:].reshape(-1)), 1)
            for x, g, square in zip((model.weights, model.listed, model.moves), (gradient, listed, pairs - seen), squares, strict=True):
                g = g / BATCH + DECAY * x
                square += (g * g).astype(np.float32)
                x -= (RATE * g / np.sqrt(square)).astype(np.float32)
    return model


def training(documents: DataFrame) -> DataFrame:
    """(lang, words): pieces of a bounded sample of the texts to learn from, those of least hashes in each language."""
    known = documents.where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL").withColumn("drawn", F.xxhash64("doc_id", "text"))
    first = Window.partitionBy("lang").orderBy("drawn")
    hashes = known.select("lang", "drawn").distinct().withColumn("place", F.row_number().over(first)).where(F.col("place") <= ROWS)
    chosen = F.broadcast(hashes.select("lang", "drawn"))  # at most ROWS a language: texts are only moved once chosen
    sample = known.join(chosen, ["lang", "drawn"], "left_semi").dropDuplicates(["lang", "drawn"]).select("lang", "text")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 64):
            out = []
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words = [w for part in words_of(text) for w in part if any(map(str.isalpha, w))]
                pieces = [words[i : i + PIECE] for i in range(0, len(words), PIECE)]
                stride = -(-len(pieces) // PIECES)
                out += [(lang, p) for p in pieces[:: max(stride, 1)]]
            columns = list(zip(*out, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.list_(pa.string()))], ["lang", "words"])

    return sample.mapInArrow(cut, "lang string, words array<string>")


def fitted(documents: DataFrame) -> Model | None:
    """The classifier, fitted in one task on the bounded sample and small enough for the driver."""

    def fit(pieces: pa.Table) -> pa.Table:
        rows = list(zip(pieces["lang"].to_pylist(), pieces["words"].to_pylist(), strict=True))
        return pa.table({"model": [pickle.dumps(vars(trained(rows)))]}, pa.schema([("model", pa.binary())]))

    rows = training(documents).withColumn("all", F.lit(0)).groupBy("all").applyInArrow(fit, "model binary").collect()
    if not rows:
        return None
    model = Model.__new__(Model)
    vars(model).update(pickle.loads(rows[0].model))
    return model


class Labeller:
    """Marginals of whole texts; emissions of words met before are kept."""

    def __init__(self, model: Model):
        self.model, self.move = model, np.exp(model.moves.astype(np.float64))
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {}
        self.known = np.empty((0, len(self.model.labels)))

    def look_up(self, words: list[str]) -> np.ndarray:
        """Rows of the table of emissions; -1 for what has no letter."""
        new = list(dict.fromkeys(w for w in words if w not in self.places))
        if new:
            lettered = [w for w in new if any(map(str.isalpha, w))]
            self.places.update((w, -1) for w in new)
            self.places.update(zip(lettered, range(len(self.known), len(self.known) + len(lettered)), strict=True))
            if lettered:
                e = self.model.emissions(lettered).astype(np.float64)
                self.known = np.concatenate([self.known, np.exp(e - e.max(axis=1, keepdims=True))])
        return np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))

    def sums(self, e: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Sums of marginals over each text; e: emissions (word, label), texts: the word at which each text begins."""
        n = e.shape[1]
        sizes = np.diff(np.append(texts, len(e)))
        blocks = -(-sizes // BLOCK)
        first = np.cumsum(blocks) - blocks  # block at which each text begins
        text = np.repeat(np.arange(len(texts)), blocks)
        inside = np.arange(len(text)) - first[text]
        begin = texts[text] + inside * BLOCK
        length = np.minimum(BLOCK, sizes[text] - inside * BLOCK)
        held = np.ones((BLOCK, len(text), n))
        valid = np.arange(BLOCK)[:, None] < length
        held[valid] = e[(begin + np.arange(BLOCK)[:, None])[valid]]
        return self.texts_of(held, valid, text, first, blocks, inside)

    def texts_of(self, e: np.ndarray, valid: np.ndarray, text: np.ndarray, first: np.ndarray, blocks: np.ndarray, inside: np.ndarray) -> np.ndarray:
        steps, count, n = e.shape
        move, alone = self.move, inside == 0
        across = np.flatnonzero(blocks > 1)
        before = np.ones((count, n))  # message into each block
        after = np.ones((count, n))
        if len(across):
            transfer = np.repeat(np.eye(n)[None], count, axis=0)
            for t in range(steps):  # every block's matrix from the label before it to its last label
                x = np.matmul(transfer, move) * e[t][:, None, :]
                x /= x.sum(axis=(1, 2), keepdims=True)
                transfer = np.where(valid[t][:, None, None], x, transfer)
            start = np.ones((count, n))
            inner = e[0][alone]
            x = inner / inner.sum(axis=1, keepdims=True)
            for t in range(1, steps):  # first blocks have no label before them
                y = (x @ move) * e[t][alone]
                x = np.where(valid[t][alone][:, None], y / y.sum(axis=1, keepdims=True), x)
            start[alone] = x
            rank = across[np.argsort(-blocks[across], kind="stable")]
            most = blocks[rank]
            for i in range(1, int(most[0])):  # block by block, all texts that have so many
                at = first[rank[: np.searchsorted(-most, -i, side="left")]] + i
                message = start[at - 1]
                before[at] = message
                x = np.einsum("ri,rij->rj", message, transfer[at])
                start[at] = x / x.sum(axis=1, keepdims=True)
            for i in range(int(most[0]) - 2, -1, -1):
                at = first[rank[: np.searchsorted(-most, -(i + 1), side="left")]] + i
                x = np.einsum("rij,rj->ri", transfer[at + 1], after[at + 1])
                after[at] = x / x.sum(axis=1, keepdims=True)
        ahead = np.empty_like(e)
        x = np.where(alone[:, None], 1.0, before @ move) * e[0]
        ahead[0] = x / x.sum(axis=1, keepdims=True)
        for t in range(1, steps):
            x = (ahead[t - 1] @ move) * e[t]
            ahead[t] = x / x.sum(axis=1, keepdims=True)
        total, back = np.zeros((count, n)), after
        for t in range(steps - 1, -1, -1):
            x = ahead[t] * back
            total += np.where(valid[t][:, None], x / x.sum(axis=1, keepdims=True), 0)
            x = (e[t] * back) @ move.T
            back = np.where(valid[t][:, None], x / x.sum(axis=1, keepdims=True), back)
        return np.add.reduceat(total, first, axis=0)

    def predictions(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
        """Language and score of each text; words of some texts are labelled together."""
        waiting: list[np.ndarray] = []
        held = 0
        for text in texts:
            rows = [self.look_up(words) for words in words_of(text)] if text else []
            rows = np.concatenate(rows) if rows else np.empty(0, np.int64)
            waiting.append(rows[rows >= 0])
            held += len(waiting[-1])
            if held >= STEP or len(self.places) >= MEMO:
                yield from self.judged(waiting)
                waiting, held = [], 0
                if len(self.places) >= MEMO:
                    self.clear()
        yield from self.judged(waiting)

    def judged(self, texts: list[np.ndarray]) -> Iterator[tuple[str, float]]:
        sizes = np.array([len(x) for x in texts], np.int64)
        full = np.flatnonzero(sizes)
        best, score = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        if len(full):
            starts = np.cumsum(sizes[full]) - sizes[full]
            mean = self.sums(self.known[np.concatenate([texts[i] for i in full])], starts) / sizes[full][:, None]
            best[full] = mean.argmax(axis=1)
            score[full] = np.clip(mean.max(axis=1), 0, 1)
        for size, k, s in zip(sizes, best, score, strict=True):
            yield (self.model.labels[k], float(s)) if size else (UNKNOWN, 0.0)


def identified(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document, see COLUMNS; texts to learn from are those whose id's checksum does not leave 2."""
    key = documents[doc_id].cast("long")
    held = F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 4 == 2
    rows = documents.select(
        key.alias("doc_id"), held.alias("held_out"), documents[text].cast("string").alias("text"), documents[lang].cast("string").alias("lang")
    )
    model = fitted(rows)

    def label(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model) if model else None
        for batch in sliced(batches, 256):
            texts = batch["text"].to_pylist()
            out = list(labeller.predictions(texts)) if labeller else [(UNKNOWN, 0.0)] * len(texts)
            columns = list(zip(*out, strict=True)) or [[], []]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(columns[0], pa.string()), pa.array(columns[1], pa.float64())],
                [c.split()[0] for c in COLUMNS.split(", ")],
            )

    return rows.select("doc_id", "held_out", "text").mapInArrow(label, COLUMNS)
