"""Compare registered queries with their SQL counterparts.

Usage: python tests/compare.py [sf] [key ...]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def sql_rows(sf_dir: str, text: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    result = connection.execute(text)
    return [d[0] for d in result.description], result.fetchall()


def normal(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(r[i] for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, sf_dir: str, build, text: str) -> str | None:
    """None when equal, else a description of the first difference."""
    df = build(spark, sf_dir)
    mine = normal(df.columns, [tuple(r) for r in df.collect()])
    columns, rows = sql_rows(sf_dir, text)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    theirs = normal(columns, rows)
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b or [type(x) for x in a] != [type(y) for y in b]]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ, first {sorted(columns)}\n   spark {bad[0][0]}\n   sql   {bad[0][1]}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from lendlens.sources.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry.queries(), entry.oracle_sql()
    chosen = sys.argv[2:] or list(queries)
    failed = 0
    for name in chosen:
        started = time.time()
        try:
            if name in oracles:
                problem = compare(spark, f"/root/testdata/sf{sf}", queries[name], oracles[name])
            else:
                rows = queries[name](spark, f"/root/testdata/sf{sf}").collect()
                problem = None if rows else "no rows"
                print("   ", rows[:3])
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{len(chosen)} queries, {failed} failed, {len(set(oracles) - set(queries))} orphan oracles")
