"""Hard-negative mining: rows near an anchor that have another label, found by rotated one-bit codes.

Vectors are scaled to integers. A row's code is the signs of its vector in a randomised Hadamard frame of more coordinates than the
vector has; with the code go the vector that the signs stand for, seen along the row (its alignment), and the length of what
remains. An anchor is cut into bit planes in the same frame, so that its product with a code is a weighted sum of popcounts, up to
the rounding of the planes. The rest of the score is the product of two remainders, and Cauchy-Schwarz bounds it: each
pair has an interval that surely holds its score. Only pairs whose interval can still change a result are scored, in integers.
Results are therefore exact; the codes decide only how many pairs are scored.

Rows and anchors are packed in blocks, and cells of anchor blocks by row blocks are worked off one by one, so a task holds a bounded
number of both; a cell returns its best few for each anchor, and those of all cells are merged. Anchors are asked twice: for rows of
their label, then for others within the bounds that these set.

Defined cases: rows with a null label, a null or empty vector, or a component that is null or not finite take no part; rows
with other vector lengths are not compared; a row with a null id is no anchor and comes last among ties; repeated anchors count
once, other repeated rows each for itself; "other" rows are those with another id; components beyond 2^24 after scaling are cut to that;
an empty table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.llm.common import spread
from leaguelake.session import stored

SCALE = 256
LARGEST = float(1 << 24)
WIDEN = 8  # coordinates of the frame for each component, at least; fewer where they would be more than WIDEST
WIDEST = 8192
PLANES = 6
PACKED = 2048  # rows or anchors packed together
TILE = 256  # anchors compared with a pack of rows at once
SCORED = 1 << 16  # pairs scored at once
ROW_PACKS, ANCHOR_PACKS = 64, 8  # packs in a cell
SLACK = 1e-6
NO_ID = (1 << 63) - 1
POSITIVES, NEGATIVES = 5, 10
LEAST, MOST = 30, 90  # per cent of the positive's score

ROW_PACK = "dim int, n int, ids binary, labels binary, vectors binary, codes binary, align binary, rest binary, square binary"
#: An anchor's bounds, and the positive that set each of them.
ANCHOR_PACK = f"{ROW_PACK}, keys binary, floors binary, ceilings binary, positives binary, marks binary"
FOUND = "anchor_id long, key long, place int, positive_id long, mark long, id long, score long"
KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


FRAMES: dict[int, tuple[np.ndarray, int]] = {}  # the last one, kept by a worker


def arrow(shape: str) -> pa.Schema:
    return pa.schema([(name, KINDS[kind]) for name, kind in map(str.split, shape.split(", "))])


def frame(dim: int) -> tuple[np.ndarray, int]:
    """(coordinates, dim) of signs: some columns of a Hadamard matrix, drawn and turned by a fixed generator. Columns are
    orthogonal, and all entries are exact."""
    if dim in FRAMES:
        return FRAMES[dim]
    size = 64
    while size < min(WIDEN * dim, max(dim, WIDEST)):
        size *= 2
    draw = np.random.default_rng(dim)
    columns, turn = draw.choice(size, dim, replace=False), draw.choice([-1.0, 1.0], dim)
    parity = np.bitwise_count(np.arange(size)[:, None] & columns[None, :]) & 1
    FRAMES.clear()
    FRAMES[dim] = (1.0 - 2.0 * parity) * turn, size
    return FRAMES[dim]


def coded(vectors: np.ndarray) -> tuple[np.ndarray, ...]:
    """Codes of integer vectors, alignment, length of the rest, and square of the vector that the code stands for."""
    signs, size = frame(vectors.shape[1])
    positive = vectors.astype(np.float64) @ signs.T >= 0
    stands = np.where(positive, 1.0, -1.0) @ signs  # exact: whole numbers
    square = np.maximum((stands * stands).sum(axis=1), 1.0)
    align = (vectors * stands).sum(axis=1) / square
    rest = vectors - align[:, None] * stands
    words = np.packbits(positive, axis=1).view(np.uint64)
    return words, align, np.sqrt((rest * rest).sum(axis=1)) * (1 + SLACK) + SLACK, square


class Asked:
    """Anchors as bit planes."""

    def __init__(self, vectors: np.ndarray):
        signs, size = frame(vectors.shape[1])
        real = vectors.astype(np.float64) @ signs.T
        self.low = real.min(axis=1)
        self.unit = np.maximum((real.max(axis=1) - self.low) / ((1 << PLANES) - 1), 1e-9)
        level = np.rint((real - self.low[:, None]) / self.unit[:, None]).astype(np.uint8)
        self.planes = [np.packbits(level >> b & 1, axis=1).view(np.uint64) for b in range(PLANES)]
        self.level = level.sum(axis=1, dtype=np.int64)
        error = real - (self.low[:, None] + self.unit[:, None] * level)
        self.error = np.abs(error).sum(axis=1) * (1 + SLACK) + SLACK  # no signs can add up to more
        self.norm = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.size = size

    def bounds(self, some: slice, codes: np.ndarray, align: np.ndarray, rest: np.ndarray, square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each of some anchors with each row."""
        ones = np.zeros((len(self.low[some]), len(codes)), np.int32)
        buffer = np.empty(ones.shape, np.uint64)
        for b, plane in enumerate(self.planes):
            for w in range(codes.shape[1]):
                np.bitwise_and(plane[some, w][:, None], codes[None, :, w], out=buffer)
                ones += np.bitwise_count(buffer).astype(np.int32) << b
        bits = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        low, unit, error = (x[some][:, None] for x in (self.low, self.unit, self.error))
        # the product of the planes with the signs: twice that with the set bits, less the whole
        near = low * (2 * bits - self.size) + unit * (2.0 * ones - self.level[some][:, None])
        sure = np.maximum(np.abs(near) - error, 0)
        aside = np.sqrt(np.maximum(self.norm[some][:, None] ** 2 - sure * sure / square, 0))
        reach = np.abs(align) * error + rest * aside
        reach += SLACK * (np.abs(near * align) + self.norm[some][:, None] * rest) + SLACK
        return near * align - reach, near * align + reach


def packs(shape: str) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function that packs rows (dim, id, label, vector, and of anchors the rest) without moving them between tasks."""
    names, schema = [c.split()[0] for c in ANCHOR_PACK.split(", ")][9:], arrow(shape)

    def pack(dim: int, rows: list[tuple]) -> dict:
        _, ids, labels, vectors, *rest = zip(*rows, strict=True)
        vectors = np.array(vectors, np.int32).reshape(len(rows), dim)
        out = {"ids": np.array([NO_ID if i is None else i for i in ids], np.int64), "labels": np.array(labels, np.int64), "vectors": vectors}
        out |= dict(zip(("codes", "align", "rest", "square"), coded(vectors), strict=True))
        out |= {k: np.array(v, np.int64) for k, v in zip(names, rest, strict=False)}
        return {"dim": dim, "n": len(rows), **{k: v.tobytes() for k, v in out.items()}}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple]] = {}
        held = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                mine = waiting.setdefault(row[0], [])
                mine.append(row)
                held += 1
                if len(mine) >= PACKED:
                    yield pa.RecordBatch.from_pylist([pack(row[0], waiting.pop(row[0]))], schema)
                    held -= PACKED
                elif held >= 8 * PACKED:  # many lengths of vectors: packs of fewer rows
                    yield pa.RecordBatch.from_pylist([pack(d, r) for d, r in waiting.items()], schema)
                    waiting, held = {}, 0
        yield pa.RecordBatch.from_pylist([pack(d, r) for d, r in waiting.items()], schema)

    return run


def unpacked(row: dict) -> dict:
    kinds = {"vectors": np.int32, "codes": np.uint64, "align": np.float64, "rest": np.float64, "square": np.float64}
    out = {k: np.frombuffer(v, kinds.get(k, np.int64)) for k, v in row.items() if isinstance(v, bytes)}
    flat = ("ids", "labels", "keys", "align", "rest", "square")
    return {k: v if k in flat else v.reshape(row["n"], -1) for k, v in out.items()} | {"n": row["n"], "dim": row["dim"]}


class Best:
    """The best few rows of each slot: highest score, then least id."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.slot, self.score, self.id = (np.empty(0, np.int64) for _ in range(3))
        self.worst = np.full(slots, np.iinfo(np.int64).min)  # of slots that are full, the last score

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        stay, last = rank < self.size, rank == self.size - 1
        self.worst[slot[last]] = score[last]
        self.slot, self.score, self.id = slot[stay], score[stay], ids[stay]


def searched(pack: dict, rows: list[dict], size: int, same: bool) -> Iterator[pa.Table]:
    """For each anchor of a pack and each of its bounds the best rows of its label (``same``) or of others."""
    asked, bounds = Asked(pack["vectors"]), pack["floors"].shape[1]
    for begin in range(0, pack["n"], TILE):
        some = slice(begin, min(begin + TILE, pack["n"]))
        best = Best((some.stop - begin) * bounds, size)
        mine, labels = pack["vectors"][some], pack["labels"][some]
        floors, ceilings = pack["floors"][some], pack["ceilings"][some]
        for r in (r for r in rows if r["dim"] == pack["dim"]):
            low, high = asked.bounds(some, r["codes"], r["align"], r["rest"], r["square"])
            least = np.maximum(floors, best.worst.reshape(-1, bounds))
            fits = np.zeros(low.shape, bool)
            for b in range(bounds):
                fits |= (high >= least[:, b, None]) & (low <= ceilings[:, b, None])
            i, j = np.nonzero(fits & ((labels[:, None] == r["labels"]) == same))
            other = r["ids"][j] != pack["ids"][some][i]
            i, j = i[other], j[other]
            score = scores_of(mine, r["vectors"], i, j)
            at, b = np.nonzero((score[:, None] >= least[i]) & (score[:, None] <= ceilings[i]))
            best.add(i[at] * bounds + b, score[at], r["ids"][j[at]])
        place, bound = best.slot // bounds + begin, best.slot % bounds
        columns = [pack["ids"][place], pack["keys"][place], bound + 1, pack["positives"][place, bound], pack["marks"][place, bound], best.id, best.score]
        yield pa.table([pa.array(c) for c in columns], [c.split()[0] for c in FOUND.split(", ")]).cast(arrow(FOUND))


def scores_of(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Integer inner products of rows of a with rows of b."""
    out = np.empty(len(i), np.int64)
    for k in range(0, len(i), SCORED):
        some = slice(k, k + SCORED)
        out[some] = np.einsum("ij,ij->i", a[i[some]].astype(np.int64), b[j[some]].astype(np.int64))
    return out


def in_cells(anchors: DataFrame, rows: DataFrame, size: int, same: bool) -> DataFrame:
    """The best of each cell, merged. A cell takes a bounded number of packs of both sides; more cells than tasks bring
    nothing, so small inputs have small cells."""
    tasks = spread(rows.sparkSession)
    packed = {"a": anchors, "r": rows}
    counts = {k: df.count() for k, df in packed.items()}
    across = max(-(-counts["a"] // ANCHOR_PACKS), 1)
    down = max(-(-counts["r"] // ROW_PACKS), min(counts["r"], -(-tasks // across)), 1)
    cells = {"a": across, "r": down}
    sides = []
    for mine, other in ("ar", "ra"):
        part = F.pmod(F.xxhash64("ids", "vectors"), F.lit(cells[mine])).cast("long")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells[other] - 1).cast("long")))
        sides.append(packed[mine].withColumn(mine, part).withColumn(other, every).groupBy("a", "r"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        packed = [unpacked(x) for x in right.to_pylist()]
        found = [t for x in left.to_pylist() for t in searched(unpacked(x), packed, size, same)]
        return pa.concat_tables([arrow(FOUND).empty_table(), *found])

    found = sides[0].cogroup(sides[1]).applyInArrow(search, FOUND)
    order = Window.partitionBy("anchor_id", "key", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def scaled(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(dim, id, label, vector) of the rows that take part: whole numbers instead of components."""
    real = F.transform(rows[vector], lambda x: x.cast("double"))
    usable = ~F.exists(real, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    least, most = F.lit(-LARGEST), F.lit(LARGEST)
    whole = F.transform(real, lambda x: F.greatest(least, F.least(most, F.floor(SCALE * F.greatest(least, F.least(most, x))).cast("double"))).cast("int"))
    tag = rows[label].cast("long")
    return rows.where(tag.isNotNull() & (F.size(rows[vector]) > 0) & usable).select(
        F.size(rows[vector]).alias("dim"), rows[vec_id].cast("long").alias("id"), tag.alias("label"), whole.alias("vector")
    )


def hundredths(c: Column, up: bool) -> Column:
    """A whole number divided by 100, rounded up or down."""
    exact = c + F.pmod(-c, F.lit(100)) if up else c - F.pmod(c, F.lit(100))
    return F.call_function("div", exact, F.lit(100))


def mined(rows: DataFrame, every: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from ``scaled`` rows. Anchors are rows whose
    id ``every`` divides."""
    rows = stored(rows, "integer-vectors")
    packed = stored(rows.mapInArrow(packs(ROW_PACK), ROW_PACK), "row-packs")
    anchors = stored(rows.where(F.col("id") % every == 0).distinct().withColumn("key", F.xxhash64("id", "label", "vector")), "anchors")

    def asked(bounds: DataFrame, name: str) -> DataFrame:
        """Anchors in packs with the columns of ``bounds``, arrays of equal lengths, behind those of rows."""
        return stored(bounds.mapInArrow(packs(ANCHOR_PACK), ANCHOR_PACK), name)

    own, added = ["dim", "id", "label", "vector", "key"], ["floors", "ceilings", "positives", "marks"]
    whole = np.iinfo(np.int64)
    unbounded = [F.array(F.lit(int(x)).cast("long")).alias(c) for x, c in zip((whole.min, whole.max, 0, 0), added, strict=True)]
    first = asked(anchors.select(*own, *unbounded), "anchor-packs")
    positives = in_cells(first, packed, POSITIVES, True)
    each = positives.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))  # at most POSITIVES

    def padded(value: Callable[[Column], Column], filling: int) -> Column:
        given = F.transform("p", value)
        return F.concat(given, F.array_repeat(F.lit(filling).cast("long"), F.lit(POSITIVES) - F.size("p")))

    bounds = [
        padded(lambda x: hundredths(x["score"] * LEAST, True), 1),  # nothing lies between 1 and 0
        padded(lambda x: hundredths(x["score"] * MOST, False), 0),
        padded(lambda x: x["id"], 0),
        padded(lambda x: x["score"], 0),
    ]
    second = asked(anchors.join(each, "key").select(*own, *(c.alias(n) for c, n in zip(bounds, added, strict=True))), "anchor-packs")
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(f"{'positive' if c == 'positive_id' else 'negative'}_id")
    return in_cells(second, packed, NEGATIVES, False).select(
        "anchor_id", known("positive_id"), "rank", known("id"), F.col("mark").alias("positive_score"), F.col("score").alias("negative_score")
    )
