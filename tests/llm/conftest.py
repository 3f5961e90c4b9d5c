import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def rows_of(seed=5):
    """Documents with copies, near copies, shared passages, nulls, repeated rows, empty and long texts."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["Über", "çà", "日本", "the", "The"]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage = text(40)
    rows = [(i, text(r.randint(1, 120))) for i in range(40)]
    base = text(200).split()
    for i in range(40, 60):
        words = list(base)
        words[r.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(60 + i, f"{text(20)} {passage}\n{text(9)}") for i in range(8)]
    rows += [(70, None), (71, ""), (72, " \t\n"), (73, "one"), (74, "One"), (None, passage), (None, None)]
    rows += [(75, text(6000)), (76, "a" * 5000), (40, rows[40][1]), (2, rows[2][1]), (77, rows[75 - 15][1])]
    return rows


@pytest.fixture(scope="module")
def rows():
    return rows_of()


@pytest.fixture(scope="module")
def documents(spark, rows):
    full = [(i, t, "x", "y", len(t or ""), 0, "clash", 7) for i, t in rows]
    shape = "doc_id long, text string, lang string, source string, n_chars int, chunk int, id string, class int"
    return spark.createDataFrame(full, shape).repartition(3)


@pytest.fixture(scope="module")
def empty(documents):
    return documents.limit(0)
