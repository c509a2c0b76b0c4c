"""Compare registered queries with their SQL at one scale: ``python -m checks.run [folder] [names...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from checks import CHECKS
from surveyloom.session import local_session

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    return value


def compare(spark, folder: str, name: str) -> tuple[str, float, int]:
    query = CHECKS[name]
    started = time.time()
    frame = query(spark, folder)
    rows = frame.collect()
    seconds = time.time() - started
    if query.sql is None:
        return "rows only", seconds, len(rows)
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    cursor = con.execute(query.sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", seconds, len(rows)
    order = sorted(names)
    mine = sorted([repr(tuple(_plain(r[c]) for c in order)) for r in rows])
    theirs = sorted([repr(tuple(_plain(r[names.index(c)]) for c in order)) for r in expected])
    if mine == theirs:
        return "equal", seconds, len(rows)
    a, b = set(mine), set(theirs)
    return (
        f"DIFFERENT rows {len(mine)} vs {len(theirs)}; {len(a - b)} / {len(b - a)} differ\n      spark "
        f"{str(sorted(a - b)[:2])[:500]}\n      sql   {str(sorted(b - a)[:2])[:500]}"
    ), seconds, len(rows)


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(CHECKS)
    spark = local_session()
    failed = []
    for name in wanted:
        try:
            result, seconds, rows = compare(spark, folder, name)
        except Exception as error:  # noqa: BLE001
            result, seconds, rows = f"ERROR {type(error).__name__}: {str(error)[:1200]}", 0.0, 0
        if result not in ("equal", "rows only"):
            failed.append(name)
        print(f"{seconds:6.2f}s {rows:7d}  {name}: {result}", flush=True)
    print(f"{len(wanted) - len(failed)} of {len(wanted)} passed; failed: {failed}")


if __name__ == "__main__":
    main()
