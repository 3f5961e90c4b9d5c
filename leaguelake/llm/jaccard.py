"""N-gram Jaccard join with prefix trees.

Documents with equal sets of word n-grams form a class; classes are joined, and linked ones form components. Every set is put in
one global order: n-grams that many documents share last, the others by hash.

1. Two sets of the needed similarity differ in few n-grams, at most k by their sizes. The hash space is cut into more than
   k parts, so some part holds the same n-grams in both. Parts are ordered by how many n-grams they hold; the first k + 1 of a
   set, for every band of sizes that its partners may fall in, are its keys. Sets that are similar share a key, and hardly others do:
   a passage or line that many documents share fills no part alone.
2. Classes that share a key meet in a block. A block's sets are stored in a prefix tree in global
   order; a set walks the tree, shares the overlap of common beginnings, and leaves a subtree when even all that
   remains cannot reach the needed overlap, or when all below is already in its component.
3. Of keys with the same classes one is kept. Classes that keys connect are a family. A family that fits a block meets there, and
   is done. In a larger one a class goes to the key that most classes have, then, in further rounds, to 8, 64, ... of its keys; a key is
   done when all its classes met there, or are in one component. A group of copies falls together in the first round and what is left
   of its family is smaller. What a round sends grows with the classes, not with their pairs; the rounds end when all keys are done.

Components are found by passing on least labels until none changes. Blocks hold about ``BLOCK`` sets; a key of more is first dealt to
several, each with the key's first set, and if that leaves several components, met block by block, so no group of copies has to fit in one task. Texts are
read once and never shuffled: sets are written with 48 bits of each hash, and each round reads them and sends on those asked for.
Which are is told by a bit table of fixed size; where it is too full to tell, more are sent and the join that follows drops them.

Defined cases: null, empty and white texts have empty sets and are linked with nothing; of fewer words than n the whole sequence is
the one n-gram; a null id is linked like any other and counts as the largest; repeated rows are copies; an empty table gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from leaguelake.llm.common import MULTIPLIERS, Hashes, binaries, found, groups, mixed, null_safe, planes, rolled, sliced, small_batches, spread, unplanes
from leaguelake.operators.history import top_per_key
from leaguelake.session import stored, temporary

N = 4
PERCENT = 85
BLOCK = 8192
WIDER = 8  # so many times the keys of a class in each further round
GRAMS = 1 << 20  # and so many n-grams
COMMON = 500  # an n-gram that one document in so many has comes last in the order
STEP = 64
ROWS = 1024  # documents among which common n-grams are counted
DROPPED = np.uint64(16)  # bits of a hash that stored sets go without
TABLE_BITS = 1 << 24
TABLE_SLICE = 1 << 16


def needed(a: int, b: int, percent: int) -> int:
    """The least overlap of sets of these sizes that are similar enough."""
    return -(-percent * (a + b) // (100 + percent))


def differ(total: int, percent: int) -> int:
    """At most the number of elements that only one of two similar sets has, whose sizes add up to this."""
    return total * (100 - percent) // (100 + percent)


def shingles(text: bytes, memo: Hashes, n: int) -> np.ndarray:
    """Distinct hashes of the n-grams of words, ascending."""
    h = memo.of(text.lower().split())
    if not len(h):
        return h
    return np.unique(mixed(rolled(h, min(n, len(h))) + np.uint64(min(n, len(h)))))


def ordered(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    last = found(h, common) >= 0
    return np.concatenate([h[~last], h[last]])


def name(h: np.ndarray) -> int:
    """The class of a set: 64 bits of its elements and their number."""
    both = np.bitwise_xor.reduce(mixed(h), keepdims=True) + (h * MULTIPLIERS[1]).sum(dtype=np.uint64, keepdims=True)
    return int(mixed(both + np.uint64(len(h))).view(np.int64)[0])


def part_keys(h: np.ndarray, percent: int) -> np.ndarray:
    """The keys of a set of 48-bit hashes, ascending. A pair's band is that of the larger set: the number of bits of its size.

    In a band the hash space has more parts than a pair can differ in elements, so at least (parts - k) are the same in both sets of
    a pair. Each set leaves out its last (parts - k - 1) by an order that only what a part holds decides: the first
    of the same parts is left out by neither."""
    size, largest, out = len(h), 100 * len(h) // percent, [np.empty(0, np.uint64)]
    for band in range(size.bit_length(), largest.bit_length() + 1):
        top = (1 << band) - 1
        k = differ(size + min(top, largest), percent)
        if not k:  # only equal sets are similar, and these are one class
            continue
        most = differ(2 * top, percent)
        parts = most + most // 8 + 3
        part = (h >> np.uint64(16)) * np.uint64(parts) >> np.uint64(32)
        start = groups(part)
        held = np.diff(np.r_[start, size])
        inside = np.add.reduceat(mixed(h), start)
        if len(start) <= k:  # empty parts come last
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), part[start])
            part = np.r_[part[start], empty]
            held, inside = (np.r_[x, np.zeros(len(empty), x.dtype)] for x in (held, inside))
        else:
            part = part[start]
        key = mixed(inside + mixed(part * np.uint64(64) + np.uint64(band)))
        out.append(key[np.lexsort((key, -held))[: k + 1]])
    return np.concatenate(out)


class Union:
    def __init__(self, count: int):
        self.up = list(range(count))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)


@dataclass
class Node:
    """A run of n-grams that all sets below share, the sets that end here, and what lies below."""

    run: list[int]
    some: int
    one: bool = True  # everything below was in one component when it was stored
    least: int = 0  # sizes of the sets below
    most: int = 0
    ends: list[int] = field(default_factory=list)
    below: dict[int, Node] = field(default_factory=dict)


class Tree:
    """Prefix tree of sets, each of which is linked, as it comes, with those stored before."""

    def __init__(self, sets: list[list[int]], percent: int):
        self.sets, self.percent, self.parts = sets, percent, Union(len(sets))
        self.root = Node([], -1, least=1 << 62)

    def add(self, i: int) -> None:
        self.visit(i)
        items, node, at = self.sets[i], self.root, 0
        while True:
            self.note(node, i)
            if at == len(items):
                node.ends.append(i)
                return
            child = node.below.get(items[at])
            if child is None:
                node.below[items[at]] = Node(items[at:], i, True, len(items), len(items), [i])
                return
            run, same = child.run, 0
            while same < len(run) and at + same < len(items) and run[same] == items[at + same]:
                same += 1
            if same < len(run):
                head = Node(run[:same], child.some, child.one, child.least, child.most)
                child.run = run[same:]
                head.below[child.run[0]] = child
                node.below[items[at]] = child = head
            node, at = child, at + same

    def note(self, node: Node, i: int) -> None:
        size = len(self.sets[i])
        node.least, node.most = min(node.least, size), max(node.most, size)
        if node.some < 0:
            node.some = i
        elif node.one and self.parts.find(node.some) != self.parts.find(i):
            node.one = False

    def visit(self, i: int) -> None:
        """Walk the tree with set i, nearest branches first, and join it to every component that a similar set is in."""
        mine, size, parts = frozenset(self.sets[i]), len(self.sets[i]), self.parts
        stack = [(self.root, 0, 0)]
        while stack:
            node, shared, depth = stack.pop()
            if node.one and node.some >= 0 and parts.find(node.some) == parts.find(i):
                continue
            # Of sets below, those of size s need needed(size, s) shared; s is between least and most.
            least = max(node.least, -(-self.percent * size // 100))
            if 100 * size < self.percent * node.least or node.most < least:
                continue
            goal, run, alive = needed(size, least, self.percent), node.run, True
            for start in range(0, len(run), STEP):
                piece = run[start : start + STEP]
                shared += len(mine.intersection(piece))
                depth += len(piece)
                # What is left of either set bounds what they can still share.
                if shared + min(size - shared, node.most - depth) < goal:
                    alive = False
                    break
            if not alive:
                continue
            for j in node.ends:
                if shared >= needed(size, len(self.sets[j]), self.percent):
                    parts.join(i, j)
            near = sorted(node.below, key=mine.__contains__)
            stack += [(node.below[x], shared, depth) for x in near]


def linked(names: list[int], sets: list[list[int]], percent: int) -> Iterator[tuple[int, int]]:
    """A link from each set's class to the first of its component in this block."""
    tree = Tree(sets, percent)
    for i in range(len(sets)):
        tree.add(i)
    for i, x in enumerate(names):
        if (root := tree.parts.find(i)) != i:
            yield x, names[root]


def components(links: DataFrame) -> DataFrame:
    """(class, component): the least class that links lead to; only linked classes."""
    both = links.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(links.select(F.col("b").alias("x"), F.col("a").alias("y")))
    both = stored(both.distinct(), "links")
    labels = stored(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("label")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, "x").select("x", F.least("label", "near").alias("label"), F.col("label").alias("old"))
        jump = labels.select(F.col("x").alias("label"), F.col("label").alias("next"))
        after = step.join(jump, "label", "left").select("x", F.least("label", "next").alias("label"), "old")
        after = stored(after, "labels")
        labels = after.select("x", "label")
        if after.where("label <> old").isEmpty():
            return labels.select(F.col("x").alias("class"), F.col("label").alias("component"))


def described(rows: DataFrame, n: int) -> DataFrame:
    """A row per document (id, n_shingles, class, items), the items being its set where the batch has it first; and a row (gram, times) for each n-gram that is common in some rows that follow each other."""
    names = ["id", "n_shingles", "class", "items", "gram", "times"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hashes()
        for batch in batches:
            seen: set[int] = set()
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                out, counted = [], [np.empty(0, np.uint64)]
                for key, value in zip(part["id"].to_pylist(), binaries(part["text"]), strict=True):
                    h = shingles(value, memo, n)
                    if not len(h):
                        out.append((key, 0, *(None,) * 4))
                        continue
                    who, items = name(h), None
                    if who not in seen:
                        seen.add(who)
                        counted.append(h)
                        items = packed(h >> DROPPED)
                    out.append((key, len(h), who, items, None, None))
                keys, times = np.unique(np.concatenate(counted), return_counts=True)
                often = (times > 1) & (times * COMMON >= part.num_rows)
                grams = (keys[often] >> DROPPED).astype(np.int64).tolist()
                out += [(*(None,) * 4, *x) for x in zip(grams, times[often].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    return rows.mapInArrow(run, "id long, n_shingles long, class long, items binary, gram long, times long")


def packed(items: np.ndarray) -> bytes:
    """An ascending set of 48-bit hashes as differences, by bytes of equal weight: the highest are nearly all zero."""
    return planes(np.diff(items, prepend=np.uint64(0)))[: 6 * len(items)]


def items_of(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data + bytes(len(data) // 3), np.uint64), dtype=np.uint64)


def bit_table(classes: DataFrame) -> np.ndarray:
    """Marks at the lowest bits of class ids: ``TABLE_BITS`` bits, however many classes there are."""

    def mark(table: pa.Table) -> pa.Table:
        bits = np.zeros(TABLE_SLICE, np.uint8)
        bits[table["at"].to_numpy()] = 1
        return pa.table([table["slice"][:1], pa.array([np.packbits(bits).tobytes()], pa.binary())], ["slice", "bits"])

    at = classes.select(F.pmod(F.col("class"), F.lit(TABLE_BITS)).alias("h")).distinct()
    slices = at.select(F.floor(F.col("h") / TABLE_SLICE).alias("slice"), (F.col("h") % TABLE_SLICE).alias("at"))
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    for r in slices.groupBy("slice").applyInArrow(mark, "slice long, bits binary").collect():
        table[r["slice"] * TABLE_SLICE // 8 : (r["slice"] + 1) * TABLE_SLICE // 8] = np.frombuffer(r["bits"], np.uint8)
    return table


def fetched(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(block, class, items): the sets of (class, block)."""
    marks = bit_table(wanted)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["class"].to_numpy() % TABLE_BITS
            yield batch.filter(pa.array((marks[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)))

    sent = sets.mapInArrow(choose, "class long, items binary")
    return sent.join(wanted.hint("merge"), "class").select("block", "class", "items")


def bucket(*columns: str) -> Column:
    """Groups are handed to Python by the bucket: some per task, not one call for each."""
    return F.pmod(F.xxhash64(*columns), F.lit(4 * spread(SparkSession.active()))).alias("bucket")


def met(sets: DataFrame, common: np.ndarray, percent: int) -> DataFrame:
    """(a, b): links of the sets of each block."""

    def meet(table: pa.Table) -> pa.Table:
        blocks: dict[int, dict[int, bytes]] = {}
        for block, who, items in zip(*(table[c].to_pylist() for c in ("block", "class", "items")), strict=True):
            blocks.setdefault(block, {})[who] = items
        links: list[tuple[int, int]] = []
        for block in blocks.values():
            names = sorted(block)
            links += linked(names, [ordered(items_of(block[c]), common).tolist() for c in names], percent)
        return pa.table([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    return sets.withColumn("bucket", bucket("block")).groupBy("bucket").applyInArrow(meet, "a long, b long")


def key_entries(sets: DataFrame, percent: int) -> DataFrame:
    """(key, class) of keys that several classes share; of keys with the same classes only one."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found_here = [part_keys(items_of(x), percent) for x in batch["items"].to_pylist()]
            who = np.repeat(batch["class"].to_numpy(), [len(x) for x in found_here])
            flat = np.concatenate([np.empty(0, np.uint64), *found_here]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(who)], ["key", "class"])

    # Found twice: that costs less than to write them.
    entries = sets.mapInArrow(keys, "key long, class long")
    shared = entries.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low <> high")
    several = stored(entries.join(shared.select("key").hint("merge"), "key", "left_semi").distinct(), "several")
    both = [F.bit_xor(F.xxhash64("class", F.lit(salt))).alias(f"code{salt}") for salt in (0, 1)]
    whose = several.groupBy("key").agg(F.count("*").alias("members"), *both)
    one = whose.groupBy("members", "code0", "code1").agg(F.min("key").alias("key"))
    return several.join(one.select("key").hint("merge"), "key", "left_semi")


def open_entries(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """(key, class, members, first) of keys whose classes are in several components."""
    placed = entries.join(labels.hint("merge"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    placed = stored(placed.select("key", "class", "component"), "placed")
    tally = placed.groupBy("key").agg(
        F.count("*").alias("members"), F.min("class").alias("first"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    return placed.select("key", "class").join(tally.where("low <> high").drop("low", "high").hint("merge"), "key")


def families_of(left: DataFrame, classes: DataFrame) -> DataFrame:
    """(class, family, large): classes that keys connect, directly or through others."""
    # A class goes to the least of its keys' first classes, and these are linked with that one: all that a class connects, without
    # a link for each two of a group.
    ways = left.select("class", "first").distinct().withColumn("to", F.min("first").over(Window.partitionBy("class")))
    ways = stored(ways, "ways")
    firsts = components(ways.where("first <> to").select(F.col("first").alias("a"), F.col("to").alias("b")).distinct())
    gone = ways.where("first = to").select("class", "to")
    found_here = gone.join(firsts.withColumnRenamed("class", "to").hint("merge"), "to", "left")
    found_here = found_here.select("class", F.coalesce("component", "to").alias("component"))
    named = found_here.join(classes.select("class", "size").hint("merge"), "class").withColumnRenamed("component", "family")
    sizes = named.groupBy("family").agg(((F.count("*") > BLOCK) | (F.sum("size") > GRAMS)).alias("large"))
    return named.select("class", "family").join(sizes.hint("merge"), "family")


def blocks_of(chosen: DataFrame, whole: bool) -> DataFrame:
    """(class, block): keys of more classes than a block holds are dealt to several, with their first class in each, or, if they
    are to be met whole, to one for each two cells."""
    cells = F.ceil(F.col("members") / BLOCK)
    mine = F.when(cells > 1, F.pmod(F.xxhash64("class"), cells)).otherwise(F.lit(0).cast("long"))
    every = F.sequence(F.lit(0).cast("long"), cells - 1)
    if whole:
        others = F.transform(every, lambda j: F.xxhash64("key", F.least("mine", j), F.greatest("mine", j)))
    else:
        here = F.transform(every, lambda j: F.xxhash64("key", j))
        others = F.when(F.col("class") == F.col("first"), here).otherwise(F.array(F.xxhash64("key", "mine")))
    return chosen.withColumn("mine", mine).select("class", F.explode(others).alias("block"))


def joined(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """One row per document: (id, n_shingles, class, component, component_id). The component is a class of it, and tells
    components apart; component_id, its least id, does not where ids are null or repeated. Documents without n-grams
    have neither class nor component, and their own id."""
    with small_batches(documents.sparkSession), temporary(documents.sparkSession):
        return stored(all_rounds(documents, doc_id, text, n, percent), "components", keep=True)


def all_rounds(documents: DataFrame, doc_id: str, text: str, n: int, percent: int) -> DataFrame:
    spark = documents.sparkSession
    rows = documents.select(documents[doc_id].cast("long").alias("id"), documents[text].cast("string").alias("text"))
    facts = stored(described(rows, n), "shingle-sets")
    docs = facts.where("gram IS NULL").select("id", "n_shingles", "class")
    sets = facts.where("items IS NOT NULL").select("class", "items")
    count = docs.agg(F.count("*")).scalar()
    often = facts.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("times").alias("times"))
    # Each such n-gram is in one of COMMON documents: there are at most COMMON times as many as a set's mean size.
    top = often.where(F.col("times") * COMMON >= count).select("gram").collect()
    common = np.sort(np.array([r.gram for r in top], np.uint64))

    facts_of = docs.where("class IS NOT NULL").groupBy("class")
    classes = stored(facts_of.agg(F.min("id").alias("first_id"), F.min("n_shingles").alias("size")), "classes")
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "class long, component long")
    entries = stored(key_entries(sets, percent), "shared-keys")
    most = 1
    while not (left := stored(open_entries(entries, labels), "open-keys")).isEmpty():
        families = stored(families_of(left, classes), "families")
        small = families.where("NOT large").select("class", F.col("family").alias("block"))
        rest = left.join(families.where("large").select("class").hint("merge"), "class", "left_semi")
        chosen = stored(top_per_key(rest, ["class"], ["-members", "key"], most), "chosen-keys")
        dealt = blocks_of(chosen, whole=most > 1).distinct()
        wanted = stored(small.unionByName(dealt), "blocks")
        links = stored(links.unionByName(met(fetched(sets, wanted), common, percent)), "block-links")
        labels = components(links)
        links = labels.select(F.col("class").alias("a"), F.col("component").alias("b"))
        # Done are keys to which all their classes came and where they met in one block, or every block with every other.
        came = chosen.groupBy("key", "members").agg(F.count("*").alias("came")).where("came = members")
        done = came.where(F.lit(most > 1) | (F.col("members") <= BLOCK))
        entries = rest.select("key", "class").join(done.select("key").hint("merge"), "key", "left_anti")
        most *= WIDER
    state = classes.join(labels, "class", "left").withColumn("component", F.coalesce("component", "class"))

    least = state.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = state.join(least, "component").select("class", "component", "component_id")
    out = docs.join(of_class, "class", "left")
    own = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "n_shingles", "class", "component", own.alias("component_id"))


def representatives(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT
) -> DataFrame:
    """The documents without near copies: of each component the row of the least id (of its rows with this id, one
    whose class comes first, and of these the one whose columns have the least digest), and all documents without n-grams."""
    chosen = joined(documents, doc_id, text, n, percent).where("class IS NOT NULL AND id <=> component_id")
    chosen = chosen.groupBy("component").agg(F.min("id").alias("__id"), F.min("class").alias("__class")).drop("component")

    def name_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Hashes()
        for batch in sliced(batches):
            sets = [shingles(t, memo, n) for t in binaries(batch[text])]
            yield batch.append_column("__class", pa.array([name(h) if len(h) else None for h in sets], pa.int64()))

    columns = documents.columns
    named = documents.mapInArrow(name_rows, StructType([*documents.schema.fields, StructField("__class", LongType())]))
    named = named.withColumn("__id", F.col(doc_id).cast("long"))
    kept = null_safe(named.where("__class IS NOT NULL"), chosen, ["__id", "__class"], "left_semi")
    tie = F.sha2(F.to_json(F.struct(*(kept[c] for c in columns))), 256)
    kept = top_per_key(kept.withColumn("__tie", tie), ["__id", "__class"], ["__tie"]).drop("__tie")
    return kept.unionByName(named.where("__class IS NULL")).select(*columns)
