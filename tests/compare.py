"""Run registered queries next to their SQL and compare rows, types and values.

    python tests/compare.py [--sf 0.01] [--partitions 8] [name-prefix ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("WAKELINE_TESTDATA", "/root/testdata")


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in sorted(os.listdir(folder)):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{folder}/{name}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


# Spark and DuckDB names of the types the queries return.
_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def compare(spark, con, folder: str, name: str, fn, sql: str | None) -> str:
    """Empty when equal, else what differs."""
    df = fn(spark, folder)
    columns = sorted(df.columns)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    ours = sorted((tuple(_plain(v) for v in r) for r in df.select(*columns).collect()), key=_key)
    if sql is None:
        return "" if ours else "no rows"
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}"
    order = [names.index(c) for c in columns]
    theirs = sorted((tuple(_plain(r[i]) for i in order) for r in result.fetchall()), key=_key)
    wrong = [f"{c}: {types[c]} vs {kinds[c]}" for c in columns if _KINDS.get(types[c]) != kinds[c]]
    if wrong:
        return "types " + ", ".join(wrong)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows vs {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b:
            bad = sum(x != y for x, y in zip(ours, theirs))
            return f"{bad}/{len(ours)} rows differ, first {columns}: {a} vs {b}"
    return "" if ours else "no rows"


def main() -> int:
    from wakeline.registry import ORACLES, QUERIES
    from wakeline.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--partitions", default="8")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    folder = f"{DATA}/sf{args.sf}"
    spark = local_session(8, **{"spark.sql.shuffle.partitions": args.partitions})
    con = database(folder)
    failed = []
    for name, fn in QUERIES.items():
        if args.names and not any(name.startswith(p) for p in args.names):
            continue
        start = time.time()
        try:
            verdict = compare(spark, con, folder, name, fn, ORACLES.get(name))
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not verdict else 'FAIL'} {time.time() - start:6.2f}s {name} {verdict}", flush=True)
        if verdict:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
