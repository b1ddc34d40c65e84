"""Run a query and its SQL over the same tables and compare them as sorted rows."""

from __future__ import annotations

from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return db


def sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, db, run, sql: str, sf_dir: str) -> int:
    ours = run(spark, sf_dir)
    theirs = db.execute(sql)
    names = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(names)
    expected = sorted_rows(names, theirs.fetchall())
    actual = sorted_rows(ours.columns, [tuple(r) for r in ours.collect()])
    assert len(actual) == len(expected)
    differing = [(a, e) for a, e in zip(actual, expected) if a != e]
    assert not differing, differing[:3]
    return len(actual)
