"""URL lists, WARC, templates, chat formatting, and the pipeline."""

import base64
import gzip
import hashlib
import os
import subprocess
import sys
from pathlib import Path

import pytest
from check import compare, connect

from leaguelake.llm import chat, templates, url_lists, warc
from leaguelake.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


def test_sql(spark):
    con = connect(SF)
    for name, sql in SQL.items():
        assert compare(con, QUERIES[name](spark, SF), sql) == ""


def test_url_lists(spark):
    captures = spark.createDataFrame(
        [(1, "http://A.b.com/x", 5), (2, "http://a.b.com", 10), (3, None, 5), (4, "nonsense", 5), (5, "http://a.b.com", None), (1, "http://A.b.com/x", 5)],
        "page_id long, url string, fetched int",
    )
    entries = spark.createDataFrame(
        [("block", "b.com", 3, "add"), ("block", "b.com", 3, "add"), ("block", "b.com", 8, "remove"), ("block", "b.com", 8, "add"),
         ("allow", "a.b.com", 10, "add"), (None, "b.com", 1, "add"), ("block", None, 1, "add")],
        "list string, pattern string, dated int, action string",
    )
    got = sorted((r.page_id, r.blocked, [x.list for x in r.listings]) for r in url_lists.decided(url_lists.listed(captures, entries)).collect())
    assert got == [(1, True, ["block"]), (1, True, ["block"]), (2, False, ["allow"]), (3, False, []), (4, False, []), (5, False, [])]
    assert all(not r.listings for r in url_lists.listed(captures, entries.limit(0)).collect())
    assert url_lists.listed(captures.limit(0), entries).count() == 0


def test_warc_round_trip(spark):
    pages = [(3, "u v", "same"), (1, None, "same"), (2, "x", None), (4, "x", ""), (5, "é", "日本"), (5, "é", "日本"), (None, "n", "same")]
    rows = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    found = warc.read(warc.write(rows))
    got = sorted((str(r.page_id), r.type, str(r.refers_to), r.payload_bytes) for r in warc.records(found).collect())
    assert got == sorted([
        ("3", "revisit", "1", 4), ("1", "response", "None", 4), ("2", "response", "None", 0), ("4", "revisit", "2", 0),
        ("5", "response", "None", 6), ("5", "response", "None", 6), ("None", "revisit", "1", 4),
    ])
    assert warc.gaps(found).count() == 0
    assert warc.read(warc.write(rows.limit(0))).count() == 0


def test_salvage():
    parts = [warc.record(i, "http://x", b"<p>%d" % i * 50, "2024-01-01T00:00:00Z", None, False) for i in range(6)]
    hurt = bytearray(b"".join(parts))
    begin = len(parts[0]) + len(parts[1])
    hurt[begin + 20 : begin + 60] = b"\0" * 40
    raw = bytes(hurt) + b"trash" + parts[0][:-9]
    out = list(warc.salvage(raw))
    kept = [x[3][0]["page-id"] for x in out if x[0] == "record"]
    assert kept == ["0", "1", "3", "4", "5", "0"]  # of the last, trailer and end of the stream are cut, no content
    lost = [(a, b) for k, a, b, _ in out if k == "gap"]
    last = len(raw) - len(parts[0][:-9])
    assert lost == [(begin, begin + len(parts[2])), (last - len(b"trash"), last)]
    cut = list(warc.salvage(parts[0] + parts[1][:-4]))  # only the trailer is cut: the record is whole and its digests agree
    assert [x[3][0]["page-id"] for x in cut if x[0] == "record"] == ["0", "1"]
    plain = b"".join(warc.member(p, 0)[0] for p in parts)
    broken = plain.replace(b"<p>3", b"<p>X", 1)
    assert [x[3][0]["page-id"] for x in warc.salvage(broken) if x[0] == "record"] == ["0", "1", "2", "4", "5"]


def foreign(held, name="x", kind="application/http; msgtype=response", **digests):
    """A record as other writers make it."""
    fields = {"WARC-Type": "response", "WARC-Record-ID": name, "Content-Type": kind, "Content-Length": len(held)}
    fields |= {f"WARC-{k.title()}-Digest": v for k, v in digests.items()}
    return warc.head(fields.items()) + held + b"\r\n\r\n"


def test_digests_of_other_writers():
    body, headers = b"<p>text</p>", b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    sha1, sha256 = hashlib.sha1(body), hashlib.sha256(body)
    good = [f"sha1:{warc.digest(body)}", f"sha1:{warc.digest(body).lower()}", f"SHA-1:{sha1.hexdigest()}", f"sha256:{sha256.hexdigest()}",
            f"sha256:{base64.b32encode(sha256.digest()).decode()}", f"md5:{hashlib.md5(body).hexdigest().upper()}",
            "blake9:abc", "sha1:odd", "nothing"]
    for stated in good:
        assert len(warc.parse(foreign(headers + body, payload=stated, block=f"sha1:{warc.digest(headers + body)}"))[1]) == len(headers + body)
        assert warc.parse(foreign(body, kind="text/html", payload=stated, block=stated))[1] == body
    coded = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\n<p>t\r\n7;a=b\r\next</p>\r\n0\r\n\r\n"
    assert warc.parse(foreign(coded, payload=good[0]))[1] == coded
    for block in (headers + b"<p>taxt</p>", coded.replace(b"ext", b"axt")):
        for stated in good[:6]:
            with pytest.raises(ValueError, match="payload-digest differs"):
                warc.parse(foreign(block, payload=stated))


def test_salvage_within_members():
    body = lambda i: b"".join(hashlib.sha256(b"%d %d" % (i, k)).hexdigest().encode() for k in range(2000))
    parts = [foreign(body(i), f"r{i}", "text/html", block=f"sha1:{warc.digest(body(i))}") for i in range(6)]
    names = lambda out: [x[3][0]["warc-record-id"] for x in out if x[0] == "record"]
    after = gzip.compress(foreign(b"later", "z", "text/html"))
    read = lambda raw: list(warc.salvage(raw + after))

    whole = b"".join(parts)
    hurt = read(gzip.compress(whole.replace(body(2)[:99], b"?" * 99)))
    assert names(hurt) == ["r0", "r1", "r3", "r4", "r5", "z"]
    assert [x[3].partition(";")[0] for x in hurt if x[0] == "gap"] == ["warc-block-digest differs"]
    first = read(gzip.compress(b"junk" + whole + b"junk"))
    assert names(first) == ["r0", "r1", "r2", "r3", "r4", "r5", "z"] and sum(x[0] == "gap" for x in first) == 2

    packed = gzip.compress(whole)
    sums = read(packed[:-8] + b"\0" * 8)
    assert names(sums) == ["r0", "r1", "r2", "r3", "r4", "r5", "z"] and [x[0] for x in sums].count("gap") == 1
    for level in (0, 6):
        packed = gzip.compress(whole, level)
        cut = list(warc.salvage(packed[: len(packed) * 7 // 12]))
        assert names(cut) == ["r0", "r1", "r2"] and cut[-1][0] == "gap" and cut[-1][3] == "member without end"
        assert names(read(packed[: len(packed) * 7 // 12])) == ["r0", "r1", "r2", "z"]

    bare = [foreign(body(i), f"r{i}", "text/html") for i in range(2)]
    assert names(read(gzip.compress(b"".join(bare))[:-8] + b"\0" * 8)) == ["z"]
    assert names(warc.salvage(gzip.compress(b"".join(bare))[:-8])) == ["r0", "r1"]


def test_templates():
    run = lambda t, **n: "".join(p for p, _ in templates.compiled(t)(n))
    assert run("{{ 'a' ~ 1 + 2 }}{% if not false and x == 'q' %}y{% else %}n{% endif %}", x="q") == "a12y"
    assert run("{% for m in l %}{{ loop.index }}{% if not loop.last %},{% endif %}{% endfor %}", l=[1, 2, 3]) == "1,2,3"
    assert run("{% set a = 'x' | upper %}{{ a }}{# no #}{{ d['k'] }}", d={"k": None}) == "X"
    folded = templates.simplified(templates.parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}x{% endif %}d"), templates.FILTERS)
    assert folded == [templates.Node("text", ("abcd",))]
    assert [x for x in templates.compiled("{% generation %}g{% endgeneration %}h")({})] == [("g", True), ("h", False)]
    for bad in ("{% if x %}", "{{ x.__class__ }}", "{{ f() }}", "{{ x | nothing }}", "{% while %}", "{{ unknown }}"):
        with pytest.raises(templates.TemplateError):
            run(bad, x="text", f=print)


def test_chat(spark, monkeypatch):
    odd = ["</s>", "\\", "[INST", "a[/INST]\\", "", None, "<<SYS>>\n[ROLE]", "é日", "x" * 500]
    rows = [(c, t, ["system", "user", "assistant", None][(c + t) % 4], odd[(c * 5 + t) % 9], 0) for c in range(6) for t in range(7)]
    rows += [(None, None, "assistant", "q", 1), (2, 3, "user", "tie", 1), (2, 3, "user", "tie", 1)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    want = {}
    for c in {r[0] for r in rows}:
        own = sorted(((r[1] if r[1] is not None else -1, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        loss = "".join(t for _, role, t in own if role == "assistant")
        digest = hashlib.sha256("".join(f"{a}\n{t}\n" for _, a, t in own).encode()).hexdigest()
        want[c] = (len(own), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    for part in (1 << 20, 30):
        monkeypatch.setattr(chat, "PART", part)
        got = {r.conv_id: tuple(r)[1:5] for r in chat.read_back(chat.formatted(table)).collect()}
        assert got == want
    assert chat.read_back(chat.formatted(table.limit(0))).count() == 0
    for t in filter(None, odd):
        assert chat.unguarded(chat.guarded(t)) == t and not any(c in chat.guarded(t) for c in chat.CONTROL)


def test_pipeline(spark, documents):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "repeated_passages", "benchmark_leaks", "token_ids"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    shape = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == "token_ids" or out.columns == shape
        docs = docs if name == "token_ids" else out
    rows = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(rows) < 200 and all(r.n_tokens == len(r.ids) for r in rows)


def test_fields_and_payloads_of_other_writers(spark, tmp_path):
    body, headers = b"<p>twelve</p>", b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    chunked = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n" + b"d\r\n" + body + b"\r\n0\r\n\r\n"
    odd = {"WARC-Type": "response", "WARC-Record-ID": "a", "Page-ID": "abc", "Payload-Length": "1e9", "Refers-To-Page": "9" * 40, "Content-Type": "text/html", "Content-Length": 3}
    archive = tmp_path / "other.warc"
    archive.write_bytes(foreign(headers + body) + foreign(chunked, name="y") + warc.head(odd.items()) + b"odd\r\n\r\n")
    found = warc.read(spark.createDataFrame([(archive.as_uri(),)], "uri string"))
    rows = warc.records(found).orderBy("offset").collect()
    assert [(bytes(r.payload), r.payload_bytes, r.digest) for r in rows] == [
        (body, 13, warc.digest(body)), (body, 13, warc.digest(body)), (b"odd", 3, warc.digest(b"odd")),
    ]
    assert [(r.page_id, r.refers_to) for r in rows] == [(None, None)] * 3 and warc.gaps(found).count() == 0


WORKERS = """
import sys
sys.path.insert(0, sys.argv[1])  # the driver has the package, its workers do not
from leaguelake.session import local_session
from leaguelake.llm.queries import QUERIES
spark = local_session(4)
spark.sql("SELECT 1").collect()
for name in sys.argv[2:]:
    print(name, QUERIES[name](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_need_no_package(tmp_path):
    root = str(Path(__file__).resolve().parents[2])
    names = [n for n in QUERIES if n != "op6_prefix_tree_jaccard"]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", WORKERS, root, *names], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [x.split()[0] for x in done.stdout.splitlines()] == names
