"""Value-by-value comparison of a registered query with its SQL equivalent."""

from __future__ import annotations

from typing import NamedTuple

VIEWS = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


class Comparison(NamedTuple):
    same: bool
    spark_rows: int
    sql_rows: int
    detail: str


def connect(sf_dir: str):
    """An in-process DuckDB connection with the test tables as views."""
    import duckdb

    con = duckdb.connect()
    for view in VIEWS:
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    return con


def _normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(df, con, sql: str) -> Comparison:
    got = _normal([tuple(r) for r in df.collect()], df.columns)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want = _normal(result.fetchall(), names)
    detail = ""
    if sorted(df.columns) != sorted(names):
        detail = f"columns {sorted(df.columns)} against {sorted(names)}"
    elif got != want:
        pair = next(((g, w) for g, w in zip(got, want) if g != w), None)
        detail = f"first difference {pair}"
    return Comparison(not detail, len(got), len(want), detail)
