"""Comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import os

import duckdb

# The given tables.
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs in columns, types or values, or None."""
    result = con.execute(sql)
    sql_kinds = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    spark_kinds = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    if spark_kinds != sql_kinds:
        return f"columns: {set(spark_kinds.items()) ^ set(sql_kinds.items())}"
    ours = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _sorted_rows(list(sql_kinds), expected)
    if len(ours) != len(theirs):
        return f"rows: {len(ours)} != {len(theirs)}"
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(unequal)} rows differ, first {unequal[0]}" if unequal else None
