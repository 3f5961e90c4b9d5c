"""The pipeline and the digest columns against plain Python, on rows with nulls, repeated ids and repeated rows."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline
from leaguelake.llm.queries import QUERIES

BYTES = Tokenizer.from_file(path("byte_bpe_50k.json"))
WORDS = Tokenizer.from_file(path("word_bpe_49k.json"))


def words(text):
    return (text or "").encode().split()


def key(i):
    return math.inf if i is None else i


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def good(docs, labels):
    trusted = {i for i, q, _ in labels if q == 1 and i is not None}
    pairs = [
        [(((a * 0x01000193 + b) & 0xFFFFFFFF) * 0x9E3779B1 & 0xFFFFFFFF) >> 20 for a, b in zip(t, t[1:], strict=False)]
        for t in ((t or "").encode() for _, t in docs)
    ]
    raw, target = Counter(), Counter()
    for (i, _), p in zip(docs, pairs, strict=True):
        raw.update(p)
        target.update(p if i in trusted else [])
    share = lambda c, x: math.log((c[x] + 0.5) / (sum(c.values()) + 0.5 * 4096))
    weight = {x: share(target, x) - share(raw, x) for x in raw}
    out = []
    for (i, t), p in zip(docs, pairs, strict=True):
        score = sum(weight[x] for x in p) / len(p) if p else 0
        assert abs(score + 0.7) > 0.001
        w = words(t)
        grams = Counter(tuple(w[a : a + 5]) for a in range(len(w) - 4))
        again = {k for a in range(len(w) - 4) if grams[tuple(w[a : a + 5])] > 1 for k in range(a, a + 5)}
        if len(w) >= 10 and 100 * len(again) <= 20 * len(w) and score >= -0.7:
            out.append((i, t))
    return out


def apart(docs):
    sets = [frozenset(tuple(w[a : a + 5]) for a in range(len(w) - 4)) for w in (words(lower(t)) for _, t in docs)]
    part = list(range(len(docs)))
    for a, x in enumerate(sets):
        for b, y in enumerate(sets[:a]):
            if part[a] != part[b] and 100 * len(x & y) >= 80 * len(x | y):
                part = [part[b] if p == part[a] else p for p in part]
    best = {}
    for p, row in zip(part, docs, strict=True):
        if p not in best or key(row[0]) < key(best[p][0]):
            best[p] = row
    return list(best.values())


def cut(docs):
    """(id, words, words removed, text that is kept)"""
    first = {}
    for i, t in docs:
        w = words(t)
        for a in range(len(w) - 12):
            g = tuple(w[a : a + 13])
            first[g] = min(first.get(g, math.inf), key(i))
    for i, t in docs:
        w = words(t)
        gone = {k for a in range(len(w) - 12) if first[tuple(w[a : a + 13])] < key(i) for k in range(a, a + 13)}
        yield i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()


def hits(docs, items):
    """(id, words, words hit, ids of items)"""
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for i, t in items:
        w = find.findall(lower(t))
        n = min(10, len(w))
        for a in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[a : a + n])].add("" if i is None else str(i))
    for i, t in docs:
        w, hit, names = find.findall(lower(t)), set(), set()
        for n in {len(k) for k in windows}:
            for a in range(len(w) - n + 1):
                if tuple(w[a : a + n]) in windows:
                    hit.update(range(a, a + n))
                    names |= windows[tuple(w[a : a + n])]
        yield i, len(w), len(hit), sorted(names)


@pytest.fixture(scope="module")
def tables(spark, rows, tmp_path_factory):
    r = random.Random(8)
    text = lambda n: " ".join(f"w{r.randrange(300)}" for _ in range(n))
    docs = [*rows, *((None, text(50)) for _ in range(3)), (90, text(60)), (90, text(60)), (91, rows[5][1])]
    docs += [docs[-2], (None, docs[-1][1]), (92, f"{text(30)} {text(20)}"), *((100 + i, f"Q#{i} ** && " * 12) for i in range(3))]
    docs += [(110 + i, " ".join(f"Q{k}##{i}**&&" for k in range(12))) for i in range(4)]
    labels = [(i, int(i < 20), 0) for i in range(40)] + [(None, 1, 0)]
    items = [(1, docs[-8][1][:90]), (2, rows[3][1]), (3, None), (None, "q1 q2")]
    pages = [(3, "u", "same"), (1, None, "same"), (2, "x", None), (5, "é", "日本"), (None, "n", "same")]
    folder = str(tmp_path_factory.mktemp("tables"))
    shapes = {
        "documents": ([(i, t, "x", "y", len(t or "")) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars int"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (items, "item_id long, text string"),
        "pages": (pages, "page_id long, url string, html string"),
    }
    for name, (data, shape) in shapes.items():
        spark.createDataFrame(data, shape).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return folder, docs, labels, items, pages


def ordered(rows):
    return sorted(map(tuple, rows), key=str)


def test_pipeline_against_plain_python(spark, tables):
    folder, docs, labels, items, _ = tables
    passed = good(docs, labels)
    single = apart(passed)
    left = [(i, kept if gone else t) for (i, t), (_, _, gone, kept) in zip(single, cut(single), strict=True) if kept or not gone]
    clean = [row for row, h in zip(left, hits(left, items), strict=True) if not h[2]]
    assert len(docs) > len(passed) > len(single) >= len(left) > len(clean) and left != single
    assert sum(i is None for i, _ in clean) >= 3 and sum(i == 90 for i, _ in clean) == 2
    want = []
    for i, t in clean:
        ids = BYTES.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), ids, t))
    assert ordered(corpus_pipeline.run(spark, folder).collect()) == ordered(want)


def test_digest_columns(spark, tables):
    folder, docs, _, items, pages = tables
    got = lambda name, *columns: ordered(QUERIES[name](spark, folder).select(*columns).collect())
    want = [(i, n, gone, sha(kept)) for i, n, gone, kept in cut(docs)]
    assert got("op1_fixed_block_repeats", "doc_id", "n_words", "n_removed", "kept_sha256") == ordered(want)
    want = [(i, n, hit, len(names), sha(",".join(names)), hit > 0) for i, n, hit, names in hits(docs, items)]
    assert got("op8_winnowing", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == ordered(want)
    want = []
    for i, t in docs:
        ids = BYTES.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(t or "")))
    assert got("op10_forced_boundary_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)
    want = []
    for i, t in docs:
        ids = np.array([*WORDS.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert got("op2_token_files", "doc_id", "n_tokens", "ids_crc32") == ordered(want)
    want = [(i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode()) for i, h in ((i, (h or "").encode()) for i, _, h in pages)]
    assert got("op9_warc", "page_id", "payload_bytes", "payload_digest") == ordered(want)


def test_near_copies_of_one_id_do_not_depend_on_the_order_of_rows(spark):
    """Two rows with one id and equal sets, but other texts: the same one stays whatever the order."""
    from leaguelake.llm.jaccard import representatives

    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "a"), (1, text.upper(), "b"), (1, text.replace(" ", "  "), "c")]
    kept = set()
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        docs = spark.createDataFrame(order, "doc_id long, text string, source string").coalesce(1)
        out = representatives(docs).collect()
        assert len(out) == 1
        kept.add(tuple(out[0]))
    assert len(kept) == 1
