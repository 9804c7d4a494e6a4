"""Run registered queries against their SQL on the same tables.

    python -m suite.check [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def normal(value):
    if value is None or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, float):
        return round(value, 9)
    return value if isinstance(value, (str, bool)) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    key = lambda row: tuple((v is None, str(v)) for v in row)
    return [columns[i] for i in order], sorted((tuple(normal(r[i]) for i in order) for r in rows), key=key)


def compare(df, con, sql: str) -> str:
    """Empty when equal, else a short description of the first difference."""
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    theirs = rows_of([d[0] for d in found.description], found.fetchall())
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b:
            bad = [(c, str(x)[:300], str(y)[:300]) for c, x, y in zip(ours[0], a, b) if x != y]
            return f"first difference {bad} in {str(a)[:120]}"
    return ""


def main() -> int:
    from factloom.session import local_session
    from suite.oracles import ORACLES
    from suite.queries import QUERIES

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(8, **{"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name in names:
        start = time.time()
        try:
            result = compare(QUERIES[name](spark, sf), con, ORACLES[name]) if name in ORACLES else "no SQL"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:500]}"
        failed += bool(result)
        print(f"{name:26s} {'ok' if not result else 'DIFFERS ' + result} ({time.time() - start:.1f}s)", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(min(main(), 1))
