"""Run registered queries in Spark and their SQL in DuckDB on the same tables and compare all rows.

    python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from catalog.all import ORACLES, QUERIES  # noqa: E402
from tidemark.session import local_session  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(r[i] for i in order) for r in rows)


_SAME = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def type_gaps(df, con, sql: str) -> list[str]:
    """Columns whose types differ between the two engines."""
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{c}: {t} / {want.get(c)}" for c, t in df.dtypes if _SAME.get(t) != want.get(c)]


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    got_names, got = df.columns, [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        return True, f"{len(got)} rows, no SQL"
    cur = con.execute(ORACLES[name])
    want_names, want = [d[0] for d in cur.description], cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return False, f"columns differ: {sorted(set(got_names) ^ set(want_names))}"
    a, b = rows_of(got_names, got), rows_of(want_names, want)
    gaps = type_gaps(df, con, ORACLES[name])
    if a == b:
        return not gaps, f"{len(got)} rows" if not gaps else f"equal values, types differ: {gaps}"
    return False, (
        f"spark {len(got)} rows, sql {len(want)} rows; columns {sorted(got_names)}\n"
        f"   only spark: {list((a - b).items())[:3]}\n   only sql:   {list((b - a).items())[:3]}"
    )


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark, con, bad = local_session("8"), duck(sf_dir), []
    for name in names:
        start = time.perf_counter()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as exc:  # report every query, not only the first that breaks
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:300]}"
        if not ok:
            bad.append(name)
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.perf_counter() - start:.1f}s  {note}", flush=True)
    print(f"{len(names) - len(bad)}/{len(names)} match; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
