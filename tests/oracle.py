"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, bytearray):
        return bytes(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str:
    """An empty text when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} against {sorted(names)}"
    expected = rows_of(names, cursor.fetchall())
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == expected:
        return "" if expected else "both empty"
    extra, missing = got - expected, expected - got
    return (
        f"{sum(got.values())} rows against {sum(expected.values())}; "
        f"extra {list(extra.items())[:3]}; missing {list(missing.items())[:3]}"
    )
