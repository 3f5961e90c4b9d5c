"""Substring dedup with fixed-block anchors.

A repeat of 13 words holds a whole block of 7 words at a multiple of 7 of the earlier document, so the blocks at such
places are the index, and every 7 words of every document probe it. Three rounds between chunks of documents and slots of
hashes (see ``common``) do this without a row per word:

1. A chunk sends each distinct hash of 7 words once (48 bits: it only has to find candidates), with marks for "is an indexed block" and "occurs more than once here".
   A slot answers which hashes are indexed somewhere and occur at two places: the anchors.
2. Around its anchors a chunk extends to all windows of 13 words that hold one, and sends each distinct window (96 bits)
   with the least document id that has it. A slot answers with the least id of all chunks.
3. A chunk marks the words of windows that a smaller id has: overlapping windows join to maximal repeats.

Defined cases: null and empty texts have no words; equal ids never remove words from each other; a null id
counts as larger than all others; repeated rows are documents of their own; an empty table gives an empty result; other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from leaguelake.llm.common import (
    MULTIPLIERS,
    Hashes,
    Lookup,
    binaries,
    by_slot,
    chunked,
    found,
    gathered,
    groups,
    mixed,
    numbers,
    planes,
    rolled,
    spread,
)

WINDOW = 13
INDEXED, TWICE = 1, 2
NO_ID = np.iinfo(np.int64).max


def block_words(window: int) -> int:
    """The longest block of which any window holds a whole one."""
    return (window + 1) // 2


def block_hashes(h: np.ndarray, block: int) -> np.ndarray:
    """48 bits for each block, at the top."""
    return rolled(h, block) & np.uint64(0xFFFFFFFFFFFF0000)


def window_hashes(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits for each window."""
    return rolled(h, window), (rolled(mixed(h), window, MULTIPLIERS[1]) >> np.uint64(32)).astype(np.uint32)


def covered(starts: np.ndarray, length: int, count: int) -> np.ndarray:
    """Which of count words are inside a window of the length that begins at one of the starts."""
    edges = np.zeros(count + 1, np.int64)
    edges[starts] += 1
    edges[starts + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def spans(mask: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8)))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2], strict=True)]


def repeats(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, carry: list[str] | None = None
) -> DataFrame:
    """(id, text, n_words, removed, kept, rest): removed lists the (start, end) of removed words, kept joins the others, rest
    has the columns to carry, if any."""
    block, slots = block_words(window), spread(documents.sparkSession)
    rows = chunked(documents, doc_id, text, carry)
    shape = "id long, text string, n_words long, removed array<struct<start:long,end:long>>, kept string"
    shape += f", rest {rows.schema['rest'].dataType.simpleString()}" if carry else ""

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        memo, all_hashes, indexed = Hashes(), [], []
        for value in binaries(table["text"]):
            h = block_hashes(memo.of(value.split()), block)
            all_hashes.append(h)
            indexed.append(h[::block])
        keys, times = np.unique(np.concatenate(all_hashes), return_counts=True)
        marks = np.where(times > 1, TWICE, 0).astype(np.uint8)
        marks[found(np.unique(np.concatenate(indexed)), keys)] |= INDEXED
        return by_slot(key[0].as_py(), slots, keys, marks, names=["keys", "marks"])

    def anchors(table: pa.Table) -> pa.Table:
        keys, row = gathered(table, "keys", np.uint64)
        marks, _ = gathered(table, "marks", np.uint8)
        order = np.argsort(keys, kind="stable")
        first = groups(keys[order])
        if not len(first):
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.binary())], ["chunk", "keys"])
        either = np.bitwise_or.reduceat(marks[order], first)
        size = np.diff(np.r_[first, len(keys)])
        good = np.repeat(((either & INDEXED) > 0) & (((either & TWICE) > 0) | (size > 1)), size)
        return answers(table, keys[order][good], row[order][good])

    def answers(table: pa.Table, keys: np.ndarray, row: np.ndarray, *columns: np.ndarray) -> pa.Table:
        """The keys, and what is said of them, for each row's chunk."""
        order = np.lexsort((keys, row))
        bounds = np.searchsorted(row[order], np.arange(table.num_rows + 1))
        used = np.flatnonzero(np.diff(bounds))
        chunks = table["chunk"].to_numpy()[used]
        packed = [[planes(c[order][bounds[r] : bounds[r + 1]]) for r in used] for c in (keys, *columns)]
        names = ["chunk", "keys", "more", "ids"] if columns else ["chunk", "keys"]
        return pa.table([pa.array(chunks, pa.int64()), *(pa.array(p, pa.binary()) for p in packed)], names)

    def extend(key: tuple, table: pa.Table, answer: pa.Table) -> pa.Table:
        memo, anchors_here = Hashes(), Lookup(np.sort(gathered(answer, "keys", np.uint64)[0]))
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        ids = numbers(table["id"], NO_ID)
        for doc, value in zip(ids, binaries(table["text"]), strict=True):
            h = memo.of(value.split())
            if len(h) < window:
                continue
            hits = np.flatnonzero(anchors_here.of(block_hashes(h, block)) >= 0)
            if len(hits):
                begins = np.zeros(len(h) + 1, np.int64)
                begins[hits + 1] = 1
                before, n = np.cumsum(begins), len(h) - window + 1
                at = np.flatnonzero(before[window - block + 1 : window - block + 1 + n] > before[:n])
                a, b = window_hashes(h, window)
                parts.append((a[at], b[at], np.full(len(at), doc)))
        parts.append((np.empty(0, np.uint64), np.empty(0, np.uint32), np.empty(0, np.int64)))
        a, b, doc = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((doc, b, a))
        a, b, doc = a[order], b[order], doc[order]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.empty(0, np.int64)
        last = np.r_[first[1:], len(a)] - 1 if len(a) else first
        several = (doc[last] != doc[first]).astype(np.uint8)
        return by_slot(key[0].as_py(), slots, a[first], b[first], doc[first], several, names=["keys", "more", "ids", "several"])

    def least(table: pa.Table) -> pa.Table:
        (a, row), (b, _) = gathered(table, "keys", np.uint64), gathered(table, "more", np.uint32)
        (doc, _), (several, _) = gathered(table, "ids", np.int64), gathered(table, "several", np.uint8)
        order = np.lexsort((doc, b, a))
        a, b, doc, several, row = a[order], b[order], doc[order], several[order], row[order]
        start = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.empty(0, bool)
        smallest = doc[np.flatnonzero(start)][np.cumsum(start) - 1] if len(a) else doc
        told = (doc > smallest) | (several > 0)
        return answers(table, a[told], row[told], b[told], smallest[told])

    def cut(key: tuple, table: pa.Table, answer: pa.Table) -> pa.Table:
        memo, values = Hashes(), binaries(table["text"])
        a, b, smallest = (gathered(answer, c, k)[0] for c, k in (("keys", np.uint64), ("more", np.uint32), ("ids", np.int64)))
        pair = a ^ (b.astype(np.uint64) << np.uint64(7))  # one column to look up; both are compared after that
        order = np.argsort(pair)
        a, b, smallest, lookup = a[order], b[order], smallest[order], Lookup(pair[order])
        counts, removed, kept = [], [], []
        for doc, value in zip(numbers(table["id"], NO_ID), values, strict=True):
            words = value.split()
            counts.append(len(words))
            starts = np.empty(0, np.int64)
            if len(a) and len(words) >= window:
                own, more = window_hashes(memo.of(words), window)
                at = lookup.of(own ^ (more.astype(np.uint64) << np.uint64(7)))
                starts = np.flatnonzero(at >= 0)
                hit = at[starts]
                starts = starts[(a[hit] == own[starts]) & (b[hit] == more[starts]) & (smallest[hit] < doc)]
            mask = covered(starts, window, len(words))
            removed.append(spans(mask))
            kept.append(b" ".join(words if not len(starts) else [w for w, gone in zip(words, mask.tolist(), strict=True) if not gone]))
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        texts = pa.array(kept, pa.binary()).cast(pa.string())
        rest = [table["rest"]] if carry else []
        return pa.table(
            [table["id"], table["text"], pa.array(counts, pa.int64()), pa.array(removed, span), texts, *rest],
            ["id", "text", "n_words", "removed", "kept", "rest"][: 5 + len(rest)],
        )

    probes = rows.groupBy("chunk").applyInArrow(probe, "slot long, chunk long, keys binary, marks binary")
    anchored = probes.groupBy("slot").applyInArrow(anchors, "chunk long, keys binary")
    windows = rows.groupBy("chunk").cogroup(anchored.groupBy("chunk")).applyInArrow(
        extend, "slot long, chunk long, keys binary, more binary, ids binary, several binary"
    )
    told = windows.groupBy("slot").applyInArrow(least, "chunk long, keys binary, more binary, ids binary")
    return rows.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(cut, shape)
