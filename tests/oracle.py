"""Compare every registered query with its SQL counterpart.

Run as a script: ``python -m tests.oracle [--sf DIR] [name ...]``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

DEFAULT_SF = "/root/testdata/sf0.01"


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if isinstance(x, float):
        return None if math.isnan(x) else repr(x + 0.0)
    if isinstance(x, (int, bool)):
        return int(x)
    return x if x is None else str(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


SAME = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def compare(df, con, sql) -> list[str]:
    """Differences between a DataFrame and a SQL result; empty if equal."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    want_types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    got = df.collect()
    if sorted(df.columns) != sorted(want_cols):
        return [f"columns {sorted(df.columns)} vs {sorted(want_cols)}"]
    out = [f"type of {c}: {t} vs {want_types[c]}" for c, t in df.dtypes if SAME.get(t, t) != want_types[c]]
    a, b = _rows(df.columns, got), _rows(want_cols, want)
    if len(a) != len(b):
        out.append(f"rows {len(a)} vs {len(b)}")
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        out.append(f"{len(bad)} rows differ, e.g. {sorted(df.columns)}: {bad[0]}")
    return out


def main(argv) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from panelwright.session import local_session

    sf = DEFAULT_SF
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark, con = local_session(8), connect(sf)
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    for name in argv or queries:
        start = time.time()
        try:
            df = queries[name](spark, sf)
            if name in oracles:
                problems = compare(df, con, oracles[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on
            problems = [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed += bool(problems)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if problems else 'ok  '} {name} [{kind}] {time.time() - start:.2f}s", *problems, sep="\n     " if problems else " ", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(sys.argv[1:])))
