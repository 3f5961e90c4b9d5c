"""WARC archives: a writer with revisit records, and a reader that goes on after damage.

Every record is a gzip member of its own. The reader checks a member's checksum, the record's head, its stated length, and the
digests of block and payload; the payload of an application/http block begins after its headers, and a digest of an unknown
algorithm or encoding is not checked. After a failed check it searches for the next place where a member or a version line
starts, goes on there, and reports the bytes between as a gap; so it does within a member's content. Of a broken member it keeps
the records that were complete before the error, but nothing of one that is cut off right after its only record.

Defined cases: a null payload is the empty one, a null url the empty text; a null id is written as none and read back as null,
sorts after all others, and such rows refer to each other only where no equal payload has an id; equal rows are records of
their own, all with the least id are responses, the others revisit it; an empty table makes no archive.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm import files
from leaguelake.session import new_folder

VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
ARCHIVE_BYTES = 1 << 25
SALTS = 16
HOT = 1000  # copies from which on references to a payload are dealt to several tasks
RECORD = (
    "uri string, offset long, length long, type string, target string, page_id long, refers_to long, digest string, "
    "payload_bytes long, payload binary"
)
GAP = "uri string, start long, end long, reason string"
LINE = regex.compile(rb"WARC/1\.[01]\r\n")
PIECE = 1 << 12  # bytes of a broken member handed to the decompressor at once
START = regex.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
ALGORITHMS = {"md5", "sha1", "sha224", "sha256", "sha384", "sha512"}
BLANK = regex.compile(rb"\r?\n\r?\n")
CHUNKED = regex.compile(rb"(?i)\ntransfer-encoding:[^\n]*chunked")
CHUNK = regex.compile(rb"([0-9A-Fa-f]+)[^\r\n]*\r\n")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def agrees(stated: str, data: bytes) -> bool | None:
    """Whether a stated digest is that of the data, in hex, base32 or base64; None where it cannot be computed."""
    algorithm, _, text = stated.partition(":")
    algorithm, text = algorithm.strip().lower().replace("-", ""), text.strip().rstrip("=")
    if algorithm not in ALGORITHMS:
        return None
    own = hashlib.new(algorithm, data).digest()
    forms = [
        (own.hex(), text.lower()),
        (base64.b32encode(own).decode().rstrip("="), text.upper()),
        (base64.b64encode(own).decode().rstrip("="), text.replace("-", "+").replace("_", "/")),
    ]
    return next((a == b for a, b in forms if len(a) == len(b)), None)


def unchunked(body: bytes) -> bytes | None:
    """The body without its chunked transfer coding; None if it is not coded so."""
    out, at = [], 0
    while (line := CHUNK.match(body, at)) is not None:
        size = int(line[1], 16)
        if size == 0:
            return b"".join(out)
        out.append(body[line.end() : line.end() + size])
        at = line.end() + size + 2
        if body[at - 2 : at] != b"\r\n":
            return None
    return None


def payloads(fields: dict[str, str], block: bytes) -> list[bytes]:
    """What the payload digest may be of: the block, or what follows its HTTP headers, as stored or without chunks; nothing
    if the record does not hold its payload."""
    if fields.get("warc-type") != "response" or "warc-segment-number" in fields:
        return []
    if not fields.get("content-type", "").lower().startswith("application/http"):
        return [block]
    blank = BLANK.search(block)
    if blank is None:
        return []
    body = block[blank.end() :]
    plain = unchunked(body) if CHUNKED.search(block, 0, blank.end()) else None
    return [body] if plain is None else [body, plain]


def digests(fields: dict[str, str], block: bytes) -> dict[str, bool]:
    """Whether each stated digest that can be computed agrees."""
    out = {}
    for name, what in (("warc-block-digest", [block]), ("warc-payload-digest", payloads(fields, block))):
        results = [agrees(fields[name], x) for x in what] if name in fields else []
        if any(r is not None for r in results):
            out[name] = any(results)
    return out


def head(pairs: Iterable[tuple[str, object]]) -> bytes:
    return b"".join([VERSION, b"\r\n", *(f"{k}: {v}\r\n".encode() for k, v in pairs if v is not None), b"\r\n"])


def record(page: int | None, url: str, payload: bytes, date: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit that only names it; one gzip member."""
    block = b"" if revisit else payload
    kept = digest(payload)
    pairs = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", regex.sub(r"\s", "%20", url)),
        ("WARC-Payload-Digest", f"sha1:{kept}"),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("Page-ID", page),
        ("Payload-Length", len(payload)),
        ("Refers-To-Page", refers_to),
        ("WARC-Profile", PROFILE if revisit else None),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", len(block)),
    ]
    press = zlib.compressobj(6, wbits=31)
    return b"".join([press.compress(head(pairs) + block + b"\r\n\r\n"), press.flush()])


def parse(raw: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Head, block and end of the record that starts here; ValueError says which check failed."""
    if not raw.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n"), at):
        raise ValueError("no version line")
    stop = raw.find(b"\r\n\r\n", at)
    if stop < 0:
        raise ValueError("head without end")
    try:
        lines = raw[at:stop].decode().split("\r\n")[1:]
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        size = int(fields["content-length"])
    except (UnicodeDecodeError, KeyError, ValueError):
        raise ValueError("head not readable") from None
    block = raw[stop + 4 : stop + 4 + size]
    end = stop + 4 + size + 4
    if size < 0 or len(block) < size or raw[end - 4 : end] != b"\r\n\r\n":
        raise ValueError("block shorter or longer than stated")
    for name, same in digests(fields, block).items():
        if not same:
            raise ValueError(f"{name} differs")
    return fields, block, end


def member(raw: bytes, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member that starts here."""
    unpack = zlib.decompressobj(wbits=31)
    try:
        content = unpack.decompress(memoryview(raw)[at:])
    except zlib.error as e:
        raise ValueError(f"member not readable: {str(e)[:60]}") from None
    if not unpack.eof:
        raise ValueError("member without end")
    return content, len(raw) - len(unpack.unused_data)


def unpacked(raw: bytes) -> tuple[bytes, str | None]:
    """What the broken member at the start gives before its error, and the error, or None if it is only cut off."""
    out, unpack = [], zlib.decompressobj(wbits=31)
    for start in range(0, len(raw), PIECE):
        before = unpack.copy()
        try:
            out.append(unpack.decompress(raw[start : start + PIECE]))
        except zlib.error as e:
            try:
                for i in range(start, start + PIECE):
                    out.append(before.decompress(raw[i : i + 1]))
            except zlib.error:
                pass
            return b"".join(out), str(e)[:60]
    return b"".join(out), None


def needed(raw: bytes, size: int) -> int:
    """How many bytes of the member at the start give the first ``size`` bytes of its content."""
    unpack, had = zlib.decompressobj(wbits=31), 0
    for start in range(0, len(raw), PIECE):
        before, had_before = unpack.copy(), had
        with contextlib.suppress(zlib.error):
            had += len(unpack.decompress(raw[start : start + PIECE]))
            if had < size:
                continue
        for i in range(start, min(start + PIECE, len(raw))):
            had_before += len(before.decompress(raw[i : i + 1]))
            if had_before >= size:
                return i + 1
    return len(raw)


def inside(content: bytes, whole: bool, sure: bool) -> tuple[list[tuple[str, object]], int]:
    """Records and gaps of a member's content, and where its last record ends. What follows that is a gap if the member is
    whole. If its checksum is not ``sure``, records count whose own digests can be computed and agree."""
    out, at, last, since, reason = [], 0, 0, None, ""
    while at < len(content):
        try:
            fields, block, end = parse(content, at)
            if not sure and not digests(fields, block):
                raise ValueError("no digest in a broken member")
        except ValueError as e:
            if since is None:
                since, reason = at, str(e)
            following = LINE.search(content, at + 1)
            at = following.start() if following else len(content)
            continue
        if since is not None:
            out.append(("gap", f"{reason}; content {since} to {at}"))
            since = None
        out.append(("record", (fields, block)))
        at = last = end
    if since is not None and whole:
        out.append(("gap", f"{reason}; content {since} to {at}"))
    return out, last


def salvage(raw: bytes) -> Iterator[tuple[str, int, int, object]]:
    """("record", start, end, (head, block)) for each that passes its checks, ("gap", start, end, reason) for all bytes between.
    What lies in a member has the member's range; that of a broken one ends with its last record."""
    at, since, reason = 0, None, ""
    while at < len(raw):
        broken, found = "", []
        try:
            if raw.startswith(MEMBER, at):
                near = raw[at : at + window(raw, at)]
                try:
                    content, end = member(near, 0)
                    found, _ = inside(content, True, True)
                except ValueError as e:
                    broken = str(e)
                    content, error = unpacked(near)
                    found, last = inside(content, False, error is None)
                    if not found:
                        raise
                    end = needed(near, last)
                end += at
            else:
                fields, block, end = parse(raw, at)
                found = [("record", (fields, block))]
        except ValueError as e:
            if since is None:
                since, reason = at, str(e)
            following = START.search(raw, at + 1)
            at = following.start() if following else len(raw)
            continue
        if len(found) == 1 and found[0][0] == "gap":
            if since is None:
                since, reason = at, found[0][1]
            at = end
            continue
        if since is not None:
            yield "gap", since, at, reason
            since = None
        for kind, what in found:
            yield kind, at, end, what
        at = end
        if broken and at < len(raw):
            since, reason = at, broken
            following = START.search(raw, at)
            at = following.start() if following else len(raw)
    if since is not None:
        yield "gap", since, len(raw), reason


def window(raw: bytes, at: int, least: int = 1 << 16) -> int:
    """How many bytes to hand to the decompressor: up to the end of the member if that is near, else all; it is found by
    trying, so that reading an archive of many members does not copy the rest of it for each."""
    size = least
    while at + size < len(raw):
        unpack = zlib.decompressobj(wbits=31)
        try:
            unpack.decompress(raw[at : at + size])
        except zlib.error:
            return size
        if unpack.eof:
            return size
        size *= 4
    return len(raw) - at


def references(pages: DataFrame) -> DataFrame:
    """(id, url, payload, first, copies): the least id of all rows with the same payload. Digests are counted within
    each task first; a payload with many copies is dealt to several tasks."""
    rows = pages.withColumn("sha", F.sha1("payload"))
    first = rows.groupBy("sha").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    salts = F.when(F.col("copies") >= HOT, F.lit(SALTS)).otherwise(F.lit(1))
    shared = first.where("copies > 1").withColumn("salts", salts)
    most = shared.where("salts > 1").orderBy(F.desc("copies"), "sha").limit(HOT)
    hot = F.broadcast(most.select("sha", F.lit(True).alias("hot")))
    dealt = shared.select("*", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    salted = rows.join(hot, "sha", "left").withColumn(
        "salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id", "url"), F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
    )
    return salted.join(dealt, ["sha", "salt"], "left").select("id", "url", "payload", "first", "copies")


def write(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html",
    least_revisit: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row and return (uri, n_records). Of equal payloads of at least ``least_revisit`` bytes
    that with the least id is the response."""
    folder = new_folder(pages.sparkSession, "warc")
    rows = references(
        pages.select(
            pages[page_id].cast("long").alias("id"),
            F.coalesce(pages[url].cast("string"), F.lit("")).alias("url"),
            F.coalesce(pages[payload].cast("string"), F.lit("")).cast("binary").alias("payload"),
        )
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, out, uri, size, done, count = TaskContext.get().partitionId(), None, "", 0, [], 0
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("id", "url", "payload", "first", "copies")]
            for page, target, body, first, copies in zip(*columns, strict=True):
                revisit = bool(copies) and len(body) >= least_revisit and first is not None and page != first
                if out is None:
                    uri = files.own_name(folder, f"{task:06d}-{len(done):04d}", ".warc.gz")
                    out, size, count = files.create(uri), 0, 0
                data = record(page, target, body, date, first if revisit else None, revisit)
                out.write(data)
                size, count = size + len(data), count + 1
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((uri, count))
                    out = None
        if out is not None:
            out.close()
            done.append((uri, count))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int64())], ["uri", "n_records"]
        )

    return files.committed(rows.mapInArrow(run, "uri string, n_records long"), "warc-list")


def read(archives: DataFrame) -> DataFrame:
    """Records and gaps of the archives in column ``uri``: a struct ``record`` or a struct ``gap`` per row."""
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def number(value: str | None) -> int | None:
        """Fields of other writers need not be numbers, nor small ones."""
        text = (value or "").strip()
        return int(text) if regex.fullmatch(r"[+-]?[0-9]{1,18}", text) else None

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"record": [x.split() for x in RECORD.split(", ")], "gap": [x.split() for x in GAP.split(", ")]}
        arrow = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
        shape = {k: pa.struct([(n, arrow[t]) for n, t in v]) for k, v in kinds.items()}

        def batch(rows: list[tuple[str, dict]]) -> pa.RecordBatch:
            arrays = [pa.array([r if kind == k else None for kind, r in rows], shape[k]) for k in ("record", "gap")]
            return pa.RecordBatch.from_arrays(arrays, ["record", "gap"])

        for listed in batches:
            for uri in listed["uri"].to_pylist():
                with files.load(uri) as f:
                    raw = f.read()
                rows, size = [], 0
                for kind, start, end, what in salvage(raw):
                    if kind == "gap":
                        rows.append((kind, {"uri": uri, "start": start, "end": end, "reason": what}))
                    else:
                        fields, block = what
                        held = (payloads(fields, block) or [block])[-1]  # behind HTTP headers, without chunks
                        stated = number(fields.get("payload-length"))
                        own = fields.get("warc-payload-digest", "").strip()
                        found = {
                            "uri": uri, "offset": start, "length": end - start, "type": fields.get("warc-type"),
                            "target": fields.get("warc-target-uri"), "page_id": number(fields.get("page-id")),
                            "refers_to": number(fields.get("refers-to-page")),
                            "digest": own.removeprefix("sha1:") or digest(held),
                            "payload_bytes": len(held) if stated is None else stated, "payload": held,
                        }
                        rows.append((kind, found))
                        size += len(held)
                    if size > 1 << 22 or len(rows) >= 4096:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    shape = f"record struct<{RECORD.replace(' ', ':').replace(',:', ',')}>, gap struct<{GAP.replace(' ', ':').replace(',:', ',')}>"
    return archives.select("uri").repartition(tasks, "uri").mapInArrow(run, shape)


def records(found: DataFrame) -> DataFrame:
    return found.where("record IS NOT NULL").select("record.*")


def gaps(found: DataFrame) -> DataFrame:
    """The log of quarantined bytes."""
    return found.where("gap IS NOT NULL").select("gap.*")
