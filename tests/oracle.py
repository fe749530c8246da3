"""Run a registered query beside its SQL and report the first difference."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(data: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(r[i] for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(df, con, sql: str) -> str | None:
    """None if both hold the same columns, value types and rows."""
    cursor = con.execute(sql)
    sql_names = [d[0] for d in cursor.description]
    names, ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql_names, theirs = _rows(sql_names, cursor.fetchall())
    if names != sql_names:
        return f"columns {names} against {sql_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(names, a))} against {dict(zip(names, b))}"
    return None
