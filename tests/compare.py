"""Compare registered queries with their DuckDB statements.

Usage: python -m tests.compare [name ...]   (folder from $SF_DIR)
"""

from __future__ import annotations

import math
import os
import sys
import time

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if hasattr(v, "as_tuple"):
        v = float(v)
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        v = v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple(
        (v is not None, type(v).__name__ if not isinstance(v, (int, float)) else "n",
         float(f"{v:.8g}") if isinstance(v, float) else v)
        for v in row
    )


def _same(a, b) -> bool:
    if isinstance(a, float) or isinstance(b, float):
        if a is None or b is None:
            return a is b
        return math.isclose(a, b, rel_tol=1e-8, abs_tol=1e-8)
    return a == b


def rows_of_duckdb(con, sql):
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    return names, cur.fetchall()


def difference(names_a, rows_a, names_b, rows_b) -> str | None:
    """None when both results hold the same columns and rows in any order."""
    if sorted(names_a) != sorted(names_b):
        return f"columns {sorted(names_a)} != {sorted(names_b)}"
    if len(rows_a) != len(rows_b):
        return f"rows {len(rows_a)} != {len(rows_b)}"
    order = sorted(names_a)
    ia = [names_a.index(n) for n in order]
    ib = [names_b.index(n) for n in order]
    # sort on exact values first, so rounding noise cannot change the pairing
    exact = [
        i
        for i in range(len(order))
        if not any(isinstance(r[ia[i]], float) for r in rows_a[:200])
    ]
    rest = [i for i in range(len(order)) if i not in exact]
    def arrange(rows, idx):
        plain = [tuple(_plain(r[i]) for i in idx) for r in rows]
        return sorted(plain, key=lambda r: _key([r[i] for i in exact + rest]))
    for x, y in zip(arrange(rows_a, ia), arrange(rows_b, ib)):
        for n, a, b in zip(order, x, y):
            if not _same(a, b):
                return f"{n}: {a!r} != {b!r} in {dict(zip(order, x))} vs {dict(zip(order, y))}"
    return None


def check(spark, con, name, query, sql, folder) -> str | None:
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    names, want = rows_of_duckdb(con, sql)
    return difference(df.columns, rows, names, want)


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = make_session()
    con = connect(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:] or list(queries)
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            if name in sqls:
                problem = check(spark, con, name, queries[name], sqls[name], folder)
                n = ""
            else:
                problem, n = None, f"rows={queries[name](spark, folder).count()} (no SQL)"
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", ""
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time()-start:.1f}s {n} {problem or ''}", flush=True)
    print(f"{len(wanted)-bad}/{len(wanted)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
