"""Compare a query with its SQL on the same tables, value by value."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    found = [tuple(row[i] for i in order) for row in rows]
    return [names[i] for i in order], sorted(found, key=repr)


def differences(df, con, sql) -> list[str]:
    """Empty when columns, types and rows agree."""
    result = con.execute(sql)
    kinds = {d[0]: str(d[1]) for d in result.description}
    names, want = _rows(list(kinds), result.fetchall())
    got_names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if names != got_names:
        return [f"columns {got_names} instead of {names}"]
    same = {
        "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
        "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean",
        "TIMESTAMP_NS": "timestamp_ntz",
    }
    found = [
        f"type of {n}: {t} instead of {kinds[n]}"
        for n, t in sorted(df.dtypes)
        if same.get(kinds[n]) != t
    ]
    if len(got) != len(want):
        found.append(f"{len(got)} rows instead of {len(want)}")
    for a, b in zip(got, want):
        if repr(a) != repr(b):
            found.append(f"got  {str(a)[:300]}\n     want {str(b)[:300]}")
            break
    return found
