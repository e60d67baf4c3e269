"""Helpers of the tests: plans, rows, and the first difference between a registered query and its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def _key(row):
    return tuple((value is None, str(type(value)), "" if value is None else value) for value in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return type(a) is type(b) and a == b


def difference(spark_df, con, sql: str) -> str | None:
    """None if columns, row count and every value agree exactly, whatever the row order."""
    names = sorted(spark_df.columns)
    relation = con.sql(sql)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    got = sorted((tuple(row) for row in spark_df.select(*names).collect()), key=_key)
    picked = ", ".join(f'"{name}"' for name in names)
    want = sorted(con.sql(f"select {picked} from ({sql})").fetchall(), key=_key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for mine, theirs in zip(got, want):
        for name, a, b in zip(names, mine, theirs):
            if not _same(a, b):
                return f"{name}: {a!r} != {b!r} in {mine} / {theirs}"
    return None if got else "no rows"
