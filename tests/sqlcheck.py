"""Compares a query with its SQL, run by DuckDB over the same tables."""

from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"


def connect(folder: str):
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[k]) for k in order) for r in rows)


def assert_same(spark, query, sql: str, folder: str = SMALL) -> None:
    df = query(spark, folder)
    found = connect(folder).execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, found.fetchall())
