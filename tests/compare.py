"""Run registered queries beside their SQL and compare rows and types.

``python tests/compare.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Spark type -> DuckDB type.
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan") if math.isnan(value) else (1, f"{value:.12g}")
    return (1, str(value))


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns, types and rows, else what differs."""
    names = sorted(df.columns)
    found = con.execute(sql)
    described = {d[0]: str(d[1]) for d in found.description}
    if sorted(described) != names:
        return f"columns {names} vs {sorted(described)}"
    types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    wrong = {n: (types[n], described[n]) for n in names if types[n] != described[n]}
    order = [d[0] for d in found.description]
    theirs = sorted(tuple(_key(dict(zip(order, r))[n]) for n in names) for r in found.fetchall())
    ours = sorted(tuple(_key(r[n]) for n in names) for r in df.collect())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if bad:
        return f"{len(bad)} rows differ, e.g. {bad[0]}"
    return f"types {wrong}" if wrong else None


def main() -> None:
    import __spark_entry__ as entry
    from carelattice.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:]
    spark = local_session("8")
    con = connect(sf_dir)
    oracle = entry.oracle_sql()
    failed = 0
    for name, query in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            if name in oracle:
                problem = difference(df, con, oracle[name])
            else:
                problem = f"no oracle, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None and name in oracle
        print(f"{name}: {problem or 'ok'} ({time.time() - start:.2f}s)", flush=True)
    print(f"{failed} problems")


if __name__ == "__main__":
    main()
