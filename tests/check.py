"""Side-by-side check of registered queries against their SQL: names, row count, values.

    python tests/check.py [sf] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "~" if math.isnan(v) else format(v + 0.0, ".9g")
    return str(v)


def canon(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str:
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canon(got, df.columns), canon(want, names)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}" if bad else ""


def main() -> None:
    import __spark_entry__ as e
    from listingguard.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    d = f"/root/testdata/sf{sf}"
    qs, sqls = e.queries(), e.oracle_sql()
    names = sys.argv[2:] or list(qs)
    spark, con = local_session(8), connect(d)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = qs[name](spark, d)
            spent = time.time()
            note = compare(df, con, sqls[name]) if name in sqls else f"no SQL, {df.count()} rows"
        except Exception as err:  # report and go on
            spent, note = time.time(), f"ERROR {str(err)[:600]}"
        bad = bool(note) and not note.startswith("no SQL")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name:24s} build {spent - start:6.1f} all {time.time() - start:6.1f} {note}", flush=True)
    print(f"{len(names)} queries, {failed} failed; without SQL: {sorted(set(qs) - set(sqls))}; unknown SQL: {sorted(set(sqls) - set(qs))}")


if __name__ == "__main__":
    main()
