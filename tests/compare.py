"""Compare a Spark result with the same query in another SQL engine, as unordered sets of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    if isinstance(value, bool) or value is None:
        return repr(value)
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str:
    """An empty text if both sides agree, else what differs."""
    result = con.sql(sql)
    names, theirs = list(result.columns), result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    ours = _rows(df.columns, df.collect())
    theirs = _rows(names, theirs)
    if ours == theirs:
        return ""
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())};"
        f" only here {list((ours - theirs).items())[:3]};"
        f" only there {list((theirs - ours).items())[:3]}"
    )
