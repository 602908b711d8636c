"""A query's rows against those of its SQL, as multisets."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, list):
        return tuple(map(_plain, value))
    return value


def sql_rows(sql: str, folder: str) -> tuple[list[str], Counter]:
    con = duckdb.connect(config={"threads": 4})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS FROM read_parquet('{folder}/{t}.parquet')")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(_plain(r[i]) for i in order) for r in found.fetchall())


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in r) for r in df.select(*[f"`{n}`" for n in names]).collect())


def difference(query, sql: str, spark, folder: str) -> str:
    """Empty where both agree; else the first rows that only one of them has."""
    mine, theirs = spark_rows(query(spark, folder)), sql_rows(sql, folder)
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} and {theirs[0]}"
    only = list((mine[1] - theirs[1]).items())[:3], list((theirs[1] - mine[1]).items())[:3]
    return "" if not any(only) else f"{mine[1].total()} and {theirs[1].total()} rows; only here {only[0]}; only in SQL {only[1]}"
