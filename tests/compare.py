"""Compare a Spark result with the same result from SQL on the same files."""

from __future__ import annotations

import math
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def value(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return v
    if isinstance(v, Decimal):
        return f"{v:.6f}"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6f}"
    if isinstance(v, (datetime, date)):
        return v.isoformat()
    return v


def rows(columns, records) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(value(r[i]) for i in order) for r in records)


def difference(df, con, sql) -> str | None:
    """What differs, or None."""
    done = con.execute(sql)
    columns = [d[0] for d in done.description]
    expected = rows(columns, done.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} instead of {sorted(columns)}"
    got = rows(df.columns, df.collect())
    if got == expected:
        return None
    missing, extra = expected - got, got - expected
    return (
        f"{sum(got.values())} rows instead of {sum(expected.values())}; "
        f"missing {sum(missing.values())}, e.g. {list(missing)[:2]}; "
        f"extra {sum(extra.values())}, e.g. {list(extra)[:2]}"
    )
