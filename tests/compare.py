"""Compare every registered query with its SQL: ``python tests/compare.py [folder] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tagloom.plans.views import TABLES  # noqa: E402

DEFAULT_DIR = "/root/testdata/sf0.01"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for table in TABLES:
        engine.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return engine


def normal(columns: list[str], rows: list[tuple]) -> list[str]:
    """Rows as sorted text, columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, engine, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    frame = query(spark, sf_dir)
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    relation = engine.sql(sql)
    want = normal(list(relation.columns), relation.fetchall())
    if sorted(frame.columns) != sorted(relation.columns):
        return False, f"columns {frame.columns} != {relation.columns}"
    if got == want:
        return True, f"{len(got)} rows"
    extra, missing = set(got) - set(want), set(want) - set(got)
    return False, f"{len(got)} vs {len(want)} rows; only here {sorted(extra)[:2]}; only there {sorted(missing)[:2]}"


def main() -> int:
    from conftest import session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else DEFAULT_DIR
    engine, spark, checks, bad = duck(sf_dir), session(), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if (args[1:] and not any(name.startswith(a) for a in args[1:])) or name not in checks:
            continue
        started = time.time()
        try:
            good, note = compare(spark, engine, sf_dir, name, query, checks[name])
        except Exception as error:  # report and go on with the next one
            good, note = False, f"{type(error).__name__} {str(error)[:300]}"
        bad += not good
        print(f"{'ok  ' if good else 'DIFF'} {name:28s} {time.time() - started:6.2f}s {note[:600]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
