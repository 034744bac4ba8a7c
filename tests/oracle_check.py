"""Compare a registered query with its SQL twin, row by row."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def differences(spark_df, con, sql: str) -> str | None:
    cols = sorted(spark_df.columns)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = Counter(tuple(_plain(r[i]) for i in at) for r in found.fetchall())
    have = Counter(tuple(_plain(v) for v in r) for r in spark_df.select(*[f"`{c}`" for c in cols]).collect())
    if want == have:
        return None
    extra, missing = have - want, want - have
    return (
        f"rows {sum(have.values())} vs {sum(want.values())}; {cols}\n"
        f" only here: {list(extra.items())[:3]}\n only in SQL: {list(missing.items())[:3]}"
    )
