"""Conversation structure repair: the cheapest edits that turn each conversation into turns that alternate.

A repaired conversation has role initials ``(s?(ua)+)?``. Rows may be kept, given the role user or assistant, or deleted, and
empty user and assistant turns may be inserted; see the costs below. A row is one of a few symbols (its role's initial and
its fault), and equal consecutive symbols are one run. A symbol is a matrix over the four states of the pattern, in the
(min, +) algebra, and a run of n is its n-th power: cheapest remaining costs pass a run through the binary powers, which are
kept, and only where choices are unrolled into letters is a run looked at row by row.

Spark sorts the rows of a conversation and streams them: symbols are read from rows without texts, and texts pass once, for the
digest, next to the edits found. Rows that are equal in conversation, turn, role and text are counted before they are sent.
Held for one conversation, in one task, are its runs and its letters (at most 9 bytes a row), never its texts.

Defined cases: null roles and texts are one space, as are null ids and turns where a row's damage is drawn; null turns come first;
equal turns are ordered by role, then by a digest of the text; rows without an id are one conversation; a role whose initial is not
s, u or a cannot be kept; long conversations need no more memory than their letters; an empty table has no conversations; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leaguelake.llm.chat import conversations

RETYPE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1  # costs; CUT_OFF is added to truncated rows that stay
SPACES = " \t\n\x0b\x0c\r"
STOPS = [".", "!", "?"]
FAULTLESS, TRUNCATED, DOOMED = 0, 1, 2  # doomed rows are blank or repeated and must go
BEGIN, SYSTEM, USER, ASSISTANT = range(4)  # states: what the repaired conversation ends with
NAMES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 60
FINAL = (0, NEVER, NEVER, 0)
BLOCK = 4096  # rows unrolled at once
PART = 1 << 20

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]

POWERS: dict[tuple, Matrix] = {}  # kept by a worker; a function that remembers by itself could not travel to one by value
STEPS: dict[tuple, tuple] = {}
MOST_STEPS = 1 << 16


def turned(state: int) -> int:
    """The turn that may follow, and the state after it."""
    return ASSISTANT if state == USER else USER


def kept(state: int, initial: str) -> int | None:
    """The state after a row that keeps its role, if it may."""
    if initial == "s":
        return SYSTEM if state == BEGIN else None
    return turned(state) if initial == {USER: "u", ASSISTANT: "a"}[turned(state)] else None


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(min(x + y for x, y in zip(row, column, strict=True)), NEVER) for column in zip(*b, strict=True)) for row in a)


def after(matrix: Matrix, costs: Vector) -> Vector:
    """Cheapest costs from each state on, one step earlier."""
    return tuple(min(min(x + y for x, y in zip(row, costs, strict=True)), NEVER) for row in matrix)


def inserts() -> Matrix:
    """Costs of going from state to state by inserted turns alone."""
    one = tuple(tuple(0 if i == j else INSERT if turned(i) == j else NEVER for j in range(4)) for i in range(4))
    return times(one, times(one, one))


def choices(symbol: tuple[str, int], state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what can be done with a row, letters in order."""
    initial, fault = symbol
    out = [("D", DELETE, state)]
    if fault != DOOMED:
        extra = CUT_OFF if fault == TRUNCATED else 0
        if (at := kept(state, initial)) is not None:
            out.append(("K", extra, at))
        out.append(("R", RETYPE + extra, turned(state)))
    return out


def power(symbol: tuple[str, int], exponent: int) -> Matrix:
    """The transition of 2 ** exponent rows of a symbol, inserted turns before each included."""
    key = (symbol, exponent)
    if key not in POWERS:
        if exponent:
            half = power(symbol, exponent - 1)
            POWERS[key] = times(half, half)
        else:
            ways = [choices(symbol, i) for i in range(4)]
            row = tuple(tuple(min((c for _, c, to in ways[i] if to == j), default=NEVER) for j in range(4)) for i in range(4))
            POWERS[key] = times(inserts(), row)
    return POWERS[key]


def through(symbol: tuple[str, int], count: int, costs: Vector) -> Vector:
    """Remaining costs before a run, from those after it."""
    exponent = 0
    while count:
        if count & 1:
            costs = after(power(symbol, exponent), costs)
        count >>= 1
        exponent += 1
    return costs


def step(symbol: tuple[str, int], later: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Remaining costs before one row, and from each state the letters that are least among the cheapest, with the state
    they lead to."""
    key = (symbol, later)
    if key not in STEPS:
        if len(STEPS) >= MOST_STEPS:
            STEPS.clear()
        now = after(power(symbol, 0), later)
        STEPS[key] = now, tuple(plan(symbol, state, now, later) for state in range(4))
    return STEPS[key]


def plan(symbol: tuple[str, int], at: int, now: Vector, later: Vector) -> tuple[str, int]:
    letters = ""
    while not letters.strip("I"):
        ways = [(letter, to) for letter, cost, to in choices(symbol, at) if cost + later[to] == now[at]]
        if now[at] == INSERT + now[turned(at)]:
            ways.append(("I", turned(at)))
        letter, at = min(ways)
        letters += letter
    return letters, at


def relative(costs: Vector) -> tuple[int, Vector]:
    """Costs above the least, which are few, so that steps are found again."""
    least = min(costs)
    return least, tuple(min(c - least, NEVER) for c in costs)


class Runs:
    """Symbols of a conversation, equal consecutive ones together."""

    def __init__(self):
        self.symbols, self.codes = [], {}
        self.code, self.count = array("B"), array("q")

    def add(self, symbol: tuple[str, int], count: int) -> None:
        if symbol not in self.codes:
            self.codes[symbol] = len(self.symbols)
            self.symbols.append(symbol)
        code = self.codes[symbol]
        if self.code and self.code[-1] == code:
            self.count[-1] += count
        else:
            self.code.append(code)
            self.count.append(count)


def cheapest(runs: Runs) -> tuple[int, str]:
    """Least cost, and the letters of the edits in order; of equally cheap ones the least text."""
    least, costs = 0, after(inserts(), FINAL)
    ends: list[Vector] = []  # remaining costs after each run, relative
    for code, count in zip(reversed(runs.code), reversed(runs.count), strict=True):
        ends.append(costs)
        more, costs = relative(through(runs.symbols[code], count, costs))
        least += more
    total, state, out = least + costs[BEGIN], BEGIN, []
    for code, count, end in zip(runs.code, runs.count, reversed(ends), strict=True):
        symbol = runs.symbols[code]
        for first in range(0, count, BLOCK):
            rows = min(BLOCK, count - first)
            later = relative(through(symbol, count - first - rows, end))[1]
            plans = []
            for _ in range(rows):
                now, plan = step(symbol, later)
                plans.append(plan)
                later = relative(now)[1]
            for plan in reversed(plans):
                letters, state = plan[state]
                out.append(letters)
    while state not in (BEGIN, ASSISTANT):
        out.append("I")
        state = turned(state)
    return total, "".join(out)


def initial_of(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


#: Rows of a conversation as they are sent: MARK makes sure that it is there, COUNT stands for all equal rows of a turn, FIRST for
#: the first row with its role and text.
MARK, COUNT, FIRST = 0, 1, 2
FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, edits string"


def examined(rows: Iterator[tuple]) -> tuple:
    """Figures and edits of one conversation, from (turn, role, digest, blank, truncated, n, kind) in order."""
    runs, doomed = Runs(), bytearray()
    figures = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
    last, low, high, turns, before = None, None, None, 0, None

    def emit(row: tuple, first: bool) -> None:
        nonlocal last, low, high, turns, before
        turn, role, _, blank, truncated, n, _ = row
        if turn is not None and (not turns or turn != last):
            low, high, last, turns = (turn if low is None else low), turn, turn, turns + 1
        letter = role[:1]
        if before is not None and before + letter not in ("su", "ua", "au"):
            figures["illegal"] += 1
        before = letter
        figures["illegal"] += n - 1
        fine = 1 if first and not blank else 0
        figures["blank"] += n if blank else 0
        figures["duplicate"] += 0 if blank else n - fine
        figures["truncated"] += fine if truncated else 0
        if fine:
            runs.add((initial_of(role), TRUNCATED if truncated else FAULTLESS), 1)
            doomed.append(0)
        if n > fine:
            runs.add(("", DOOMED), n - fine)
            doomed.extend(b"\1" * (n - fine))

    waiting = None
    for row in rows:
        kind = row[-1]
        if kind == COUNT:
            if waiting:
                emit(waiting, False)
            waiting = row
        elif kind == FIRST:
            emit(waiting, True)
            waiting = None
    if waiting:
        emit(waiting, False)
    cost, audit = cheapest(runs)
    edits, place = [], 0
    for letter in audit:  # what concerns rows that do not have to go
        if letter == "I" or not doomed[place]:
            edits.append(letter)
        place += letter != "I"
    gaps = high - low + 1 - turns if turns else 0
    return (gaps, *figures.values(), cost, audit, "".join(edits))


def digest_of(edits: str, rows: Iterator[tuple[str, str]]) -> str:
    """SHA-256 of the repaired conversation; rows are (role, text) in order."""
    digest, state, at, lines = hashlib.sha256(), BEGIN, 0, 0

    def put(role: str, text: str) -> None:
        nonlocal lines
        digest.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
        lines += 1

    def inserted() -> None:
        nonlocal at, state
        while at < len(edits) and edits[at] == "I":
            state, at = turned(state), at + 1
            put(NAMES[state], "")

    for role, text in rows:
        inserted()
        letter, at = edits[at], at + 1
        if letter == "K":
            state = kept(state, initial_of(role))
            put(role, text)
        elif letter == "R":
            state = turned(state)
            put(NAMES[state], text)
    inserted()
    return digest.hexdigest()


def turns_of(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, n): the columns used, nulls of roles and texts as one space; each row once."""
    return rows.select(
        rows[conv_id].cast("long").alias("conv_id"),
        rows[turn].cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("n"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut, repeated or given another role, as a checksum of (conv_id, turn) draws it."""
    words = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    drawn = turns.withColumn("draw", F.crc32(F.concat(words[0], F.lit(":"), words[1])) % 20).where("draw <> 0")
    text: Column = F.when(F.col("draw") == 1, F.lit("")).when(F.col("draw") == 2, F.translate("text", "".join(STOPS), ""))
    return drawn.select(
        "conv_id",
        "turn",
        F.when(F.col("draw") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("draw") == 3, F.col("n") * 2).otherwise(F.col("n")).alias("n"),
    )


def batches_of(out: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about a million characters."""
    ready: list[tuple] = []
    held = 0
    for row in out:
        ready.append(row)
        held += 64 + size(row)
        if held >= PART:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ready, strict=True), schema, strict=True)], schema=schema)
            ready, held = [], 0
    columns = zip(*ready, strict=True) if ready else [[]] * len(schema)
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def repaired(turns: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``turns`` (see ``turns_of``) and of ``every``: figures of its faults, cost and letters of its
    cheapest repair, and the digest of the repaired conversation."""
    ids = (turns if every is None else every).select("conv_id").distinct()
    trimmed = F.rtrim("text", F.lit(SPACES))
    facts = turns.withColumns(
        {
            "digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256)),
            "blank": F.trim("text", F.lit(SPACES)) == "",
            "truncated": ~F.substring(trimmed, -1, 1).isin(STOPS),
        }
    )
    same = ["conv_id", "turn", "role", "digest", "blank", "truncated"]
    counted = facts.groupBy(*same).agg(F.sum("n").alias("n")).withColumn("kind", F.lit(COUNT))
    earliest = Window.partitionBy("conv_id", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    firsts = facts.withColumn("place", F.row_number().over(earliest)).where("place = 1").drop("place")
    nothing = {c: F.lit(None).cast(t) for c, t in facts.dtypes if c in (*same[1:], "n")}
    marks = ids.withColumns(nothing).withColumn("kind", F.lit(MARK))
    columns = [*same, "n", "kind"]
    sent = counted.select(columns).unionByName(marks.select(columns))
    sent = sent.unionByName(firsts.withColumn("kind", F.lit(FIRST)).select(columns))
    first_of_all = F.when(F.col("kind") == MARK, 0).otherwise(1)
    order = [F.col("conv_id").asc_nulls_first(), first_of_all, *(F.col(c).asc_nulls_first() for c in ("turn", "role", "digest")), F.col("kind")]
    found_kind = pa.schema([(c.split()[0], pa.string() if "string" in c else pa.int64()) for c in FOUND.split(", ")])

    def examine(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ((*key, *examined(rows)) for key, rows in conversations(batches))
        yield from batches_of(out, found_kind, lambda r: 2 * len(r[-2]))

    found = sent.repartition("conv_id").sortWithinPartitions(*order).select(columns).mapInArrow(examine, FOUND)

    names = [c.split()[0] for c in FOUND.split(", ")]
    texts = firsts.where("NOT blank").select("conv_id", "turn", "role", "digest", "text", F.lit(1).alias("kind"))
    beside = found.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True).repartition("conv_id")
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "kind", "turn", "role", "digest")]
    told_kind = pa.schema([*list(found_kind)[:-1], pa.field("repaired_sha256", pa.string())])

    def tell(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = ((*key, *finished(rows)) for key, rows in conversations(batches))
        yield from batches_of(out, told_kind, lambda r: len(r[-2]))

    told = f"{FOUND.removesuffix('edits string')}repaired_sha256 string"
    return beside.sortWithinPartitions(*order).select(*names, "role", "text").mapInArrow(tell, told)


def finished(rows: Iterator[tuple]) -> tuple:
    """Figures as found, and the digest, from the row with the edits and the rows with texts behind it."""
    *figures, edits, _, _ = next(rows)
    return (*figures, digest_of(edits, (row[-2:] for row in rows)))
