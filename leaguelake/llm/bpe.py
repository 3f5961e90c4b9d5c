"""BPE encoding and decoding with forced boundaries.

A pair of bytes that no token of the vocabulary holds side by side can never be merged across, so a word may be cut
there: the fragments are encoded each for itself and their ids joined. Words are what the vocabulary's splitting pattern
finds; the ids of short words are kept, so that each is cut and merged once in a while only.

Defined cases: null is encoded as the empty text, which has no ids; special tokens named in a text become their ids;
an unpaired or unknown id cannot arise from encoding and fails decoding; rows that repeat are encoded each for itself.
"""

from __future__ import annotations

import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

MEMO = 300_000
MEMO_LENGTH = 64  # longer words are not remembered
LONG = 200
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: how the vocabulary's authors split texts before merging.
PATTERN = r" ?[LETTER]+| ?[NUMBER]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^WHITELETTERNUMBER]+|[WHITE]+(?![^WHITE])|[WHITE]+"
UNICODE = {"LETTER": r"\p{L}", "NUMBER": r"\p{N}", "WHITE": WHITE}
LATIN = {"LETTER": "A-Za-zªµºÀ-ÖØ-öø-ÿ", "NUMBER": "0-9²³¹¼-¾", "WHITE": r"\t-\r \x85\xa0"}


def splitter(classes: dict[str, str]) -> str:
    return re.sub("LETTER|NUMBER|WHITE", lambda m: classes[m[0]], PATTERN)


def is_latin(text: str) -> bool:
    """Whether all characters are of Latin-1, for which the pattern's classes can be written out."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_letters() -> dict[str, int]:
    """Which byte each letter of a byte-level vocabulary stands for: printable bytes stand for themselves, the
    others are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Tokens as bytes, rank and result of each merge, special tokens, and which byte pairs are inside some token."""

    def __init__(self, definition: str):
        whole = json.loads(definition)
        model, letters = whole["model"], byte_letters()
        raw = {t: bytes(letters[c] for c in t) for t in model["vocab"]}
        ids = model["vocab"]
        merges = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.pairs = {(ids[a], ids[b]): (r, ids[a + b]) for r, (a, b) in enumerate(merges)}
        self.never = (len(self.pairs), -1)
        self.single = [ids[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.tokens = {i: raw[t] for t, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        self.inside = {p for t in raw.values() for p in zip(t, t[1:], strict=False)}


def merged(piece: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of a fragment: the pair of least rank is merged, the leftmost first, until none is left."""
    ids = [vocabulary.single[b] for b in piece]
    get, never = vocabulary.pairs.get, vocabulary.never
    if len(ids) > LONG:
        return merged_long(ids, get)
    found = [get(p, never) for p in zip(ids, ids[1:], strict=False)]
    while found and (least := min(found)) is not never:
        i = found.index(least)
        ids[i : i + 2] = [least[1]]
        del found[i]
        if i < len(found):
            found[i] = get((ids[i], ids[i + 1]), never)
        if i:
            found[i - 1] = get((ids[i - 1], ids[i]), never)
    return ids


def merged_long(ids: list[int], get) -> list[int]:
    """The same with a queue, for fragments whose pairs are too many to look through after each merge."""
    after, before, dead = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1)), -1
    queue = [(m[0], i, a, b, m[1]) for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False)) if (m := get((a, b)))]
    heapq.heapify(queue)
    while queue:
        _, i, a, b, new = heapq.heappop(queue)
        j = after[i]
        if ids[i] != a or j >= len(ids) or ids[j] != b:
            continue
        ids[i], ids[j] = new, dead
        after[i] = k = after[j]
        if k < len(ids):
            before[k] = i
            if m := get((new, ids[k])):
                heapq.heappush(queue, (m[0], i, new, ids[k], m[1]))
        h = before[i]
        if h >= 0 and (m := get((ids[h], new))):
            heapq.heappush(queue, (m[0], h, ids[h], new, m[1]))
    return [i for i in ids if i != dead]


class Encoder(dict):
    """Words and their ids as 32-bit integers, little-endian."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.latin, self.any = re.compile(splitter(LATIN)), regex.compile(splitter(UNICODE))
        self.special = re.compile("|".join(map(re.escape, vocabulary.special))) if vocabulary.special else None

    def __missing__(self, word: str) -> bytes:
        ids = array("I", self.word(word.encode())).tobytes()
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO:
                self.clear()
            self[word] = ids
        return ids

    def word(self, raw: bytes) -> list[int]:
        """Ids of the fragments between forced boundaries, one after the other."""
        inside, out, start = self.vocabulary.inside, [], 0
        for end, pair in enumerate(zip(raw, raw[1:], strict=False), 1):
            if pair not in inside:
                out += merged(raw[start:end], self.vocabulary)
                start = end
        return out + merged(raw[start:], self.vocabulary)

    def ordinary(self, text: str) -> bytes:
        words = (self.latin if is_latin(text) else self.any).findall(text)
        return b"".join(map(self.__getitem__, words))

    def encode(self, text: str) -> np.ndarray:
        out, at = [], 0
        for m in self.special.finditer(text) if self.special else ():
            out += [self.ordinary(text[at : m.start()]), array("I", [self.vocabulary.special[m[0]]]).tobytes()]
            at = m.end()
        return np.frombuffer(b"".join([*out, self.ordinary(text[at:])]), "<u4")


def read_definition(path: str) -> str:
    """The vocabulary file, read by the driver: tasks get its content, not its place."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(documents: DataFrame, definition: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids, decoded): the token ids of each text, and the text that decoding them gives."""
    rows = documents.select(documents[doc_id].cast("long").alias("id"), documents[text].cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(definition)
        encoder, tokens = Encoder(vocabulary), vocabulary.tokens
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                ids = [encoder.encode(t or "") for t in part["text"].to_pylist()]
                back = [b"".join(map(tokens.__getitem__, x.tolist())).decode("utf-8", "replace") for x in ids]
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([part["id"], lists, pa.array(back, pa.string())], ["id", "ids", "decoded"])

    return rows.mapInArrow(run, "id long, ids array<int>, decoded string")
