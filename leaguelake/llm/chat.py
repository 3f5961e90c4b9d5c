"""Chat formatting: conversations rendered by a compiled template, with a mask of the text to be learned.

A conversation is rendered turn by turn from sorted rows, without being held whole, and written in parts of about a
million characters (most conversations have one). Control strings inside roles and texts are escaped by a backslash before
their last character, backslashes are doubled; reading back undoes both.

Defined cases: a null text or role is the empty one; null turns come first, equal turns are ordered by role, then text;
repeated rows are turns of their own; rows without a conversation id form one conversation, read back with a null id;
an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.templates import compiled
from leaguelake.session import stored

#: Strings that steer a model, and none of which may come from a text unescaped.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "<<SYS>>", "<</SYS>>"]
TEMPLATE = (
    "{% for m in messages %}{% if loop.first %}<s>{% endif %}[ROLE]{{ m.role | guarded }}[/ROLE]"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.content | guarded }}{% endgeneration %}"
    "{% else %}[INST]{{ m.content | guarded }}[/INST]{% endif %}</s>{% endfor %}"
)
PART = 1 << 20
INSIDE = regex.compile(r"\\|" + "|".join(map(regex.escape, CONTROL)))
MARKED = regex.compile("|".join(map(regex.escape, CONTROL)))
GUARD = regex.compile(r"\\(.)", regex.S)


def guarded(text: object) -> str:
    """The text without control strings."""
    return INSIDE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][:-1]}\\{m[0][-1]}", "" if text is None else str(text))


def unguarded(text: str) -> str:
    return GUARD.sub(r"\1", text) if "\\" in text else text


def conversations(batches: Iterable[pa.RecordBatch], keys: int = 1) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(key, rows) of each run of equal first columns, rows being read as they are asked for."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    row = next(rows, None)

    while row is not None:
        key = row[:keys]

        def run(key=key) -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[:keys] == key:
                current, row = row, next(rows, None)
                yield current[keys:]

        rest = run()
        yield key, rest
        for _ in rest:  # what was not asked for
            pass


def formatted(
    rows: DataFrame, template: str = TEMPLATE, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, part, text, mask): the rendered conversations; mask lists the (start, end) of marked characters of a part."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    turns = rows.select(
        rows[conv_id].cast("long").alias("conv_id"),
        rows[turn].cast("long").alias("turn"),
        F.coalesce(rows[role].cast("string"), F.lit("")).alias("role"),
        F.coalesce(rows[text].cast("string"), F.lit("")).alias("text"),
    )
    dealt = turns.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compiled(template, {"guarded": guarded})
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        kinds = [pa.int64(), pa.int64(), pa.string(), span]
        names = ["conv_id", "part", "text", "mask"]
        out: list[tuple] = []
        held = 0

        def batch(ready: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in ready], k) for i, k in enumerate(kinds)], names)

        for (key,), turns in conversations(batches):
            pieces, mask, at, part = [], [], 0, 0
            for piece, marked in render({"messages": ({"role": r, "content": t} for r, t in turns)}):
                if marked:
                    mask.append({"start": at, "end": at + len(piece)})
                pieces.append(piece)
                at += len(piece)
                if at >= PART:
                    out.append((key, part, "".join(pieces), mask))
                    held += at
                    pieces, mask, at, part = [], [], 0, part + 1
                if held >= PART:
                    yield batch(out)
                    out, held = [], 0
            if pieces or not part:
                out.append((key, part, "".join(pieces), mask))
                held += at
        yield batch(out)

    shape = "conv_id long, part long, text string, mask array<struct<start:long,end:long>>"
    return stored(dealt.mapInArrow(run, shape), "formatted-conversations")


def read_back(written: DataFrame) -> DataFrame:
    """Per conversation, from the written parts alone: turns and digests of them and of the text under the mask."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("part")]
    parts = written.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "text", "mask")

    def turns(parts: Iterator[tuple], masked: list) -> Iterator[tuple[str, str]]:
        """Cut the text at control strings; one that straddles two parts is cut when the second is there."""
        rest = ""
        for text, mask in parts:
            masked[0] += len(text)
            for span in mask:
                plain = unguarded(text[span["start"] : span["end"]])
                masked[1] += len(plain)
                masked[2].update(plain.encode())
            rest += text
            at, role, begun, content = 0, "", 0, None
            for m in MARKED.finditer(rest):
                if m[0] == "[ROLE]":
                    begun = m.end()
                elif m[0] == "[/ROLE]":
                    role, begun = unguarded(rest[begun : m.start()]), m.end()
                elif m[0] == "[INST]":
                    begun = m.end()
                elif m[0] == "[/INST]":
                    content = rest[begun : m.start()]
                elif m[0] == "</s>":
                    yield role, unguarded(rest[begun : m.start()] if content is None else content)
                    at, content = m.end(), None
            rest = rest[at:]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (key,), parts in conversations(batches):
            masked: list = [0, 0, hashlib.sha256()]
            count, digest = 0, hashlib.sha256()
            for role, text in turns(parts, masked):
                count += 1
                digest.update(f"{role}\n{text}\n".encode())
            out.append((key, count, digest.hexdigest(), masked[1], masked[2].hexdigest(), masked[0]))
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names)

    shape = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return parts.mapInArrow(run, shape)
