"""Compare registered queries with their SQL on the given tables: ``python tests/check.py [sf] [name ...]``."""

from __future__ import annotations

import datetime
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v: object) -> object:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def normal(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def compare(con, df, sql: str) -> str:
    rows = df.collect()
    names = df.columns
    con.execute(f"CREATE OR REPLACE TEMP VIEW checked AS {sql}")
    result = con.execute("SELECT * FROM checked")
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    if sorted(names) != sorted(kinds):
        return f"columns {sorted(names)} != {sorted(kinds)}"
    left, right = normal(names, rows), normal(list(kinds), expected)
    if left != right:
        extra, missing = sorted(set(left) - set(right))[:2], sorted(set(right) - set(left))[:2]
        return f"{len(left)} rows against {len(right)}; columns {sorted(names)}\n    got  {extra}\n    want {missing}"
    types = [(n, t, kinds[n]) for n, t in df.dtypes if t in KINDS and KINDS[t] != kinds[n]]
    return f"types differ: {types}" if types else ""


def main(sf: str = "0.01", *wanted: str) -> int:
    from leaguelake.session import local_session

    spark = local_session(8)
    from leaguelake.queries import QUERIES, SQL

    sf_dir = f"/root/testdata/sf{sf}"
    con = connect(sf_dir)
    bad = 0
    for name, run in QUERIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(con, df, SQL[name]) if name in SQL else ""
            note = "" if name in SQL else f"rows only ({df.count()})"
        except Exception as e:  # report and go on
            problem, note = "".join(traceback.format_exception_only(e))[:700], ""
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {time.time() - start:6.2f}s {name} {note}{problem}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
