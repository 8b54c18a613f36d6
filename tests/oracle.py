"""Compares registered queries with their DuckDB equivalents."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between the Spark result and the SQL result, or None."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = [dict(zip(names, row)) for row in cursor.fetchall()]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} but SQL has {sorted(names)}"
    order = sorted(names)

    def lines(rows):
        return sorted(repr([r[n] for n in order]) for r in rows)

    actual, wanted = lines(r.asDict() for r in df.collect()), lines(expected)
    if len(actual) != len(wanted):
        return f"{len(actual)} rows but SQL has {len(wanted)}"
    wrong = [(a, w) for a, w in zip(actual, wanted) if a != w]
    return f"{len(wrong)} rows differ, first: {order} spark {wrong[0][0]} sql {wrong[0][1]}" if wrong else None
