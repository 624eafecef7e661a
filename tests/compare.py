"""Run a registered query and its SQL side by side and compare all values.

``python tests/compare.py sf0.01 [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(folder: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else 0.0 + value
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """(row count, first difference or None)."""
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want = _sorted(result.fetchall(), want_names)
    got = _sorted([tuple(r) for r in df.collect()], df.columns)
    if sorted(want_names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} != {sorted(want_names)}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows, SQL has {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b or [type(x) is bool for x in a] != [type(x) is bool for x in b]:
            return len(got), f"{a} != {b}"
    return len(got), None


def main() -> None:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__

    QUERIES, ORACLES = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    from pairwarden.session import local_session

    folder = str(ROOT / (sys.argv[1] if len(sys.argv) > 1 else "sf0.01"))
    names = sys.argv[2:] or list(QUERIES)
    spark = local_session(int(os.environ.get("CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(folder)
    bad = 0
    for name in names:
        begin = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in ORACLES:
                rows, problem = compare(df, con, ORACLES[name])
            else:
                rows, problem = df.count(), None
        except Exception as err:  # report and go on with the next query
            rows, problem = -1, f"{type(err).__name__}: {str(err)[:600]}"
        bad += problem is not None
        kind = "sql" if name in ORACLES else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {name:26} {kind:4} {rows:8} rows {time.time() - begin:6.2f} s"
              + (f"  {problem[:900]}" if problem else ""), flush=True)
    print(f"{len(names)} queries, {bad} failed")


if __name__ == "__main__":
    main()
