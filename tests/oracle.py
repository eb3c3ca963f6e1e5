"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows.

    python -m tests.oracle [--sf 0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import math
import os
import sys
import time
from decimal import Decimal

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def local_session(cpus: str = "8") -> SparkSession:
    from kontora.session import build_session

    spark = build_session(
        "kontora-tests", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g",
           "spark.sql.warehouse.dir": "/tmp/kontora-warehouse"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _clean(v):
    if isinstance(v, Decimal):
        return ("dec", str(v))
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_clean(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _clean(x)) for k, x in v.items()))
    return v


def _sortable(row):
    return tuple((type(v).__name__ if v is not None else "", f"{v:.6g}" if isinstance(v, float) else str(v)) for v in row)


def _near(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)
    return type(a) is type(b) and a == b


def compare(df, con, sql: str) -> str:
    """'' when equal, else the first difference found."""
    rel = con.execute(sql)
    want_cols = [d[0] for d in rel.description]
    loose = [d[0] for d in rel.description if str(d[1]).startswith(("HUGEINT", "DECIMAL"))]
    if loose:
        return f"sql columns need a cast: {loose}"
    want = rel.fetchall()
    got_cols = df.columns
    if sorted(got_cols) != sorted(want_cols):
        return f"columns differ: spark only {sorted(set(got_cols) - set(want_cols))}, sql only {sorted(set(want_cols) - set(got_cols))}"
    got = df.collect()
    if len(got) != len(want):
        return f"rows differ: spark {len(got)}, sql {len(want)}"
    names = sorted(got_cols)
    gi = [got_cols.index(n) for n in names]
    wi = [want_cols.index(n) for n in names]
    g = sorted((tuple(_clean(r[i]) for i in gi) for r in got), key=_sortable)
    w = sorted((tuple(_clean(r[i]) for i in wi) for r in want), key=_sortable)
    exact = True
    for a, b in zip(g, w):
        for n, x, y in zip(names, a, b):
            if not _near(x, y):
                return f"column {n}: spark {x!r} ({type(x).__name__}), sql {y!r} ({type(y).__name__}) in\n   {a}\n   {b}"
            if x != y:
                exact = False
    return "" if exact else "~"


def main(argv=None) -> int:
    p = argparse.ArgumentParser()
    p.add_argument("names", nargs="*")
    p.add_argument("--sf", default="0.01")
    p.add_argument("--module")
    a = p.parse_args(argv)
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from kontora.queries import catalog

    folder = f"/root/testdata/sf{a.sf}"
    spark = local_session()
    con = connect(folder)
    queries, sqls = catalog.queries(), catalog.oracle_sql()
    names = a.names or list(queries)
    if a.module:
        names = [n for n in names if catalog.MODULE_OF[n] == a.module]
    bad = []
    for n in names:
        start = time.time()
        try:
            df = queries[n](spark, folder)
            if n in sqls:
                out = compare(df, con, sqls[n])
            else:
                rows = df.count()
                out = "" if rows else "no rows"
        except Exception as e:  # report and go on
            out = f"{type(e).__name__}: {str(e)[:900]}"
        took = time.time() - start
        mark = {"": "ok  ", "~": "near"}.get(out, "FAIL")
        if mark == "FAIL":
            bad.append(n)
        print(f"{mark} {n} {took:.1f}s {'sql' if n in sqls else 'rows-only'} {out if mark == 'FAIL' else ''}", flush=True)
    print(f"{len(names) - len(bad)} of {len(names)} agree; bad: {bad}")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
