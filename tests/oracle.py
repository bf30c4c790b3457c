"""Comparing a registered query with its SQL on the test tables."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v + 0.0
    return v


def rows_of_spark(df) -> Counter:
    names = sorted(df.columns)
    return Counter(tuple(_value(row[n]) for n in names) for row in df.collect())


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    at = [names.index(n) for n in sorted(names)]
    return sorted(names), Counter(tuple(_value(row[i]) for i in at) for row in result.fetchall())
