"""Hard negatives, conversation repair and language identification against plain Python."""

import hashlib
import itertools
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leaguelake.llm import language, negatives, repair
from leaguelake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- conversation repair


def accepted(initials):
    rest = initials.removeprefix("s")
    return not initials or (rest != "" and rest == "ua" * (len(rest) // 2))


def plain_repair(rows):
    """The cheapest edits of (role, text, fault) rows by trying states row by row, with whole strings as candidates."""
    ends = {"": (0, "", [])}  # what the result ends with: nothing, s, u, a

    def inserted(ways):
        ways = dict(ways)
        for _ in range(3):
            for end, (cost, audit, lines) in list(ways.items()):
                to = "a" if end == "u" else "u"
                new = (cost + 2, audit + "I", [*lines, ({"u": "user", "a": "assistant"}[to], "")])
                if to not in ways or new[:2] < ways[to][:2]:
                    ways[to] = new
        return ways

    for role, text, fault in rows:
        after = {}
        for end, (cost, audit, lines) in inserted(ends).items():
            options = [(end, 3, "D", [])]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                turn = "a" if end == "u" else "u"
                if role[:1] == turn or (role[:1] == "s" and end == ""):
                    options.append((role[:1], more, "K", [(role, text)]))
                options.append((turn, 2 + more, "R", [({"u": "user", "a": "assistant"}[turn], text)]))
            for to, price, letter, line in options:
                new = (cost + price, audit + letter, lines + line)
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        ends = after
    cost, audit, lines = min((v for k, v in inserted(ends).items() if k in ("", "a")), key=lambda x: x[:2])
    assert accepted("".join(role[:1] for role, _ in lines))
    return cost, audit, "\n".join(f"{r}:{t}" for r, t in lines)


def plain_conversations(rows):
    spaces = " \t\n\x0b\x0c\r"
    held = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        out = held.setdefault(conv, [])
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else text.translate(str.maketrans("", "", ".!?")) if draw == 2 else text
        out += [(turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)
    for conv, out in held.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in out:
            bare = text.strip(spaces)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault))
        turns = [t for t, _, _ in out if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(out))
        cost, audit, text = plain_repair(marked)
        yield (conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def turns(seed=3):
    r = random.Random(seed)
    words = ["yes.", "no!", "well", "why?", "ok", "", " \t", None, "Same text."]
    rows = []
    for conv in range(150):
        for turn in range(r.randint(1, 9)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, r.choice([turn, turn, turn, turn + 2, None]), role, r.choice(words)))
    rows += [(900, i, "user", "the same.") for i in range(60)]
    rows += [(901, i, "assistant" if i % 2 else "user", f"turn {i}." if i % 7 else f"turn {i}") for i in range(300)]
    rows += [(902, None, "user", "a."), (902, None, "user", "a."), (None, 1, "user", "b."), (None, None, None, None)]
    rows += [(903, 5, "user", "x" * 40_000)]
    return rows


def test_repair(spark):
    rows = turns()
    shape = "conv_id long, turn int, role string, text string, n int, kind string, digest int, edits long"
    given = spark.createDataFrame([(*r, 1, "clash", 2, 3) for r in rows], shape).repartition(3)
    parts = repair.turns_of(given)
    got = repair.repaired(repair.damaged(parts), parts)
    want = list(plain_conversations(rows))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert any(w[6] > 5 for w in want) and any("I" in w[7] for w in want)
    none = repair.turns_of(given.limit(0))
    assert repair.repaired(repair.damaged(none), none).count() == 0


def test_repair_runs():
    """Long runs: powers and unrolled blocks agree with row-by-row choices."""
    r = random.Random(1)
    for case in range(60):
        rows, runs = [], repair.Runs()
        for _ in range(r.randint(0, 5)):
            role, fault = r.choice(["user", "assistant", "system", "tool"]), r.choice([None, "blank", "truncated"])
            count = r.choice([1, 2, 3, 17, 64])
            rows += [(role, "t", fault)] * count
            kind = {None: repair.FAULTLESS, "truncated": repair.TRUNCATED, "blank": repair.DOOMED}[fault]
            runs.add(("" if fault == "blank" else repair.initial_of(role), kind), count)
        cost, audit, _ = plain_repair(rows)
        assert repair.cheapest(runs) == (cost, audit), case
    before, repair.BLOCK = repair.BLOCK, 7
    try:
        runs = repair.Runs()
        runs.add(("u", repair.FAULTLESS), 100)
        assert repair.cheapest(runs) == plain_repair([("user", "t", None)] * 100)[:2]
    finally:
        repair.BLOCK = before


# ---------------------------------------------------------------- hard negatives


def plain_negatives(rows):
    usable = []
    for i, v, y in rows:
        if y is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, y, [max(min(math.floor(256 * float(np.float32(x))), 1 << 24), -(1 << 24)) for x in v]))
    last = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a, y, v in {(i, y, tuple(v)): (i, y, v) for i, y, v in usable if i is not None and i % 100 == 0}.values():
        scored = [(sum(p * q for p, q in zip(v, w, strict=True)), i, z) for i, z, w in usable if i != a and len(w) == len(v)]
        for p, i in sorted([(s, i) for s, i, z in scored if z == y], key=last)[:5]:
            fit = sorted([(s, j) for s, j, z in scored if z != y and 30 * p <= 100 * s <= 90 * p], key=last)
            out += [(a, i, k, j, p, s) for k, (s, j) in enumerate(fit[:10], 1)]
    return out


def vectors(seed=2, count=420, dim=12):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(4, dim))
    rows = []
    for i in range(count):
        y = int(r.integers(4))
        rows.append((i, [float(x) for x in (centres[y] + r.normal(size=dim)).astype(np.float32)], y))
    rows += [(i, rows[7][1], k % 3) for k, i in enumerate(range(500, 560))]  # many equal vectors
    rows += [(600, rows[100][1], 1), (600, rows[3][1], 2), (100, rows[100][1], rows[100][2]), (None, rows[5][1], 1), (700, [0.0] * dim, 1)]
    rows += [(800, None, 1), (801, [], 1), (802, [float("nan")] * dim, 1), (803, [float("inf")] * dim, 1), (804, [None] * dim, 1)]
    rows += [(900, [1.0, 2.0, 3.0], 0), (901, [1.0, 2.0, 2.5], 0), (902, [1.0, 1.0, 1.0], 1), (1000, rows[9][1], None), (903, [1e30, 1.0, 0.0], 1)]
    return rows


@pytest.mark.parametrize("packed", [2048, 16])
def test_negatives(spark, packed, monkeypatch):
    for name, value in {"PACKED": packed, "ROW_PACKS": 3, "ANCHOR_PACKS": 1, "TILE": 4, "SCORED": 50}.items():
        monkeypatch.setattr(negatives, name, value)
    rows = vectors()
    shape = "vec_id long, embedding array<float>, label int, key int, a int, r int, dim string, id string, score int"
    given = spark.createDataFrame([(*x, 1, 2, 3, "d", "i", 4) for x in rows], shape).repartition(5)
    got = [tuple(x) for x in negatives.mined(negatives.scaled(given)).collect()]
    want = plain_negatives(rows)
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(want) > 100
    assert negatives.mined(negatives.scaled(given.limit(0))).count() == 0


def test_intervals_hold_and_prune():
    r = np.random.default_rng(4)
    a, b = (r.integers(-60, 60, size=(n, 64)) for n in (40, 3000))
    code, align, rest, square = negatives.coded(b)
    low, high = negatives.Asked(a).bounds(slice(0, 40), code, align, rest, square)
    exact = a @ b.T
    assert (low <= exact).all() and (exact <= high).all()
    reach = np.linalg.norm(a, axis=1)[:, None] * np.linalg.norm(b, axis=1)
    assert ((high - low) / reach).mean() < 0.7  # against 2 without codes
    best = np.sort(exact, axis=1)[:, -10:-9]
    assert (high >= best).mean() < 0.35  # most pairs need no score


# ---------------------------------------------------------------- language identification


def plain_marginals(e, moves):
    """Label marginals by all label sequences."""
    out = np.zeros_like(e)
    for path in itertools.product(range(e.shape[1]), repeat=len(e)):
        w = math.exp(sum(e[t, y] for t, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
        for t, y in enumerate(path):
            out[t, y] += w
    return out / out.sum(axis=1, keepdims=True)


def test_marginals(monkeypatch):
    r = np.random.default_rng(0)
    model = language.Model(["a", "b", "c"], {})
    model.moves = r.normal(size=(3, 3))
    e = r.normal(size=(7, 3)) * 2
    want = plain_marginals(e, model.moves)
    each, pairs = language.marginals(e[:, None, :], model.moves)
    assert np.allclose(each[:, 0], want) and np.isclose(pairs.sum(), 6)
    monkeypatch.setattr(language, "BLOCK", 2)
    others = [r.normal(size=(n, 3)) for n in (1, 2, 5, 4)]
    parts = [e, *others]
    starts = np.cumsum([0, *(len(p) for p in parts)])[:-1]
    sums = language.Labeller(model).sums(np.exp(np.concatenate(parts)), starts)
    assert np.allclose(sums, [plain_marginals(p, model.moves).sum(axis=0) for p in parts])


def test_gradient():
    """Pair sums and marginals are the derivatives of the log partition sum."""
    r = np.random.default_rng(1)
    e, moves = r.normal(size=(4, 1, 2)), r.normal(size=(2, 2))

    def total(e, moves):
        return math.log(sum(math.exp(sum(e[t, 0, y] for t, y in enumerate(p)) + sum(moves[a, b] for a, b in itertools.pairwise(p))) for p in itertools.product((0, 1), repeat=4)))

    each, pairs = language.marginals(e, moves)
    for i, j in itertools.product((0, 1), repeat=2):
        step = np.zeros((2, 2))
        step[i, j] = 1e-6
        assert abs((total(e, moves + step) - total(e, moves - step)) / 2e-6 - pairs[i, j]) < 1e-5
    step = np.zeros_like(e)
    step[2, 0, 1] = 1e-6
    assert abs((total(e + step, moves) - total(e - step, moves)) / 2e-6 - each[2, 0, 1]) < 1e-5


def test_language(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    odd = [(None, None, "en"), (-1, "", "en"), (-2, "12 34 ½ ²", "fr"), (-3, "the and of " * 30_000, None), (-4, "x", None), (-3, "the", None)]
    given = rows.unionByName(spark.createDataFrame(odd, rows.schema)).withColumns({"score": F.lit("clash"), "place": F.lit(1), "held_out": F.lit(3)})
    out = language.identified(given.repartition(3)).join(rows.withColumnRenamed("lang", "truth").drop("text"), "doc_id", "left").collect()
    assert len(out) == rows.count() + len(odd)
    held = [x for x in out if x.held_out and x.truth]
    assert sum(x.lang_pred == x.truth for x in held) / len(held) > 0.9
    assert all(0 <= x.score <= 1 for x in out)
    assert all(x.held_out == (zlib.crc32(str("" if x.doc_id is None else x.doc_id).encode()) % 4 == 2) for x in out)
    got = {(x.doc_id, x.lang_pred, x.score) for x in out if x.doc_id in (None, -1, -2)}
    assert got == {(None, "und", 0.0), (-1, "und", 0.0), (-2, "und", 0.0)}
    assert {x.lang_pred for x in out if x.doc_id == -3} == {"en"}
    assert language.identified(given.limit(0)).count() == 0
    untaught = language.identified(given.withColumn("lang", F.lit(None).cast("string")).limit(5)).collect()
    assert {(x.lang_pred, x.score) for x in untaught} == {("und", 0.0)}


def test_switched_text(spark):
    """Words of a text that switches its language are labelled piece by piece."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").where("lang IN ('en', 'de') AND n_chars > 400").select("doc_id", "text", "lang")
    model = language.fitted(rows.withColumn("held_out", F.lit(False)))
    texts = {r.lang: r.text for r in rows.collect()}
    words = {k: [w for part in language.words_of(t) for w in part][:20] for k, t in texts.items()}
    e = model.emissions(words["en"] + words["de"]).astype(float)
    each, _ = language.marginals(e[:, None, :], model.moves.astype(float))
    truth = [model.labels.index(k) for k in ("en", "de") for _ in range(20)]
    assert (each[:, 0].argmax(axis=1) == truth).mean() > 0.9


def test_queries(spark):
    columns = {
        "op11_rotated_codes": "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint",
        "op12_conversation_repair": "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string",
        "op13_language_chain": "doc_id bigint, held_out boolean, lang_pred string, score double",
    }
    for name, want in columns.items():
        out = QUERIES[name](spark, SF)
        assert ", ".join(map(" ".join, out.dtypes)) == want
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op12_conversation_repair"](spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(plain_conversations(rows))
