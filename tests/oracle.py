"""Run a registered query and its SQL over the same tables and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_text(row[i]) for i in order) for row in rows), key=repr)


def _text(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return value


def difference(spark_df, con, sql: str) -> str | None:
    """None when both give the same columns and rows, else a short account."""
    relation = con.execute(sql)
    columns = [d[0] for d in relation.description]
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(columns)}"
    theirs = canonical_rows(columns, relation.fetchall())
    ours = canonical_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if ours == theirs:
        return None
    extra = [r for r in ours if r not in set(theirs)][:2]
    lacking = [r for r in theirs if r not in set(ours)][:2]
    return f"{len(ours)} vs {len(theirs)} rows; only ours {extra}; only theirs {lacking}"
