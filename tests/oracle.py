"""Run a query in Spark and its SQL twin in DuckDB and compare all rows."""

from __future__ import annotations

from pathlib import Path

import duckdb


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, query, sql):
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    assert got[0] == want[0], (got[0], want[0])
    assert len(got[1]) == len(want[1]), (len(got[1]), len(want[1]))
    wrong = [(g, w) for g, w in zip(got[1], want[1]) if g != w]
    assert not wrong, wrong[:3]
    return len(got[1])
