"""Run a query in Spark and its SQL in DuckDB and compare the rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(value):
    return repr(float(value)) if isinstance(value, float) else repr(value)


def rows_of_frame(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_value(row[n]) for n in names) for row in df.collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(_value(r[i]) for i in order) for r in cursor.fetchall())


def difference(df, con, sql: str) -> str:
    """'' if both give the same rows, else what differs."""
    names, ours = rows_of_frame(df)
    other_names, theirs = rows_of_sql(con, sql)
    if names != other_names:
        return f"columns {names} vs {other_names}"
    if ours == theirs:
        return ""
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} vs {sum(theirs.values())} rows; {sum(extra.values())} only in Spark,"
        f" e.g. {next(iter(extra), None)}; {sum(missing.values())} only in SQL, e.g. {next(iter(missing), None)}"
    )
