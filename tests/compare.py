"""Compare a Spark result with the SQL result on the same files, as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def norm(x):
    if isinstance(x, bool):
        return int(x)
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, int):
        return float(x)
    if isinstance(x, (datetime.datetime, datetime.date)):
        return str(x)
    if isinstance(x, (list, tuple)):
        return tuple(norm(i) for i in x)
    return x


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def difference(df, con, text):
    """None when equal, else a short description."""
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = bag(names, cur.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return None if sum(want.values()) else "empty"
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"extra {list((got - want).items())[:2]}; missing {list((want - got).items())[:2]}"
    )
