"""Run a registered query on Spark and its statement on DuckDB and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, bool):
        return int(value)
    return value


def kind(name: str) -> str:
    name = name.lower()
    for part, group in (("int", "int"), ("double", "float"), ("float", "float"), ("decimal", "decimal"),
                        ("char", "text"), ("string", "text"), ("bool", "bool"), ("timestamp", "time"), ("date", "date")):
        if part in name:
            return "hugeint" if "huge" in name else group
    return name


def compare(spark, queries, oracle, name: str, sf_dir: str) -> str | None:
    frame = queries[name](spark, sf_dir)
    rows = [tuple(plain(row[col]) for col in sorted(frame.columns)) for row in frame.collect()]
    if name not in oracle:
        return None if rows else "no rows"
    relation = duck(sf_dir).sql(oracle[name])
    columns = sorted(relation.columns)
    if columns != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} / {columns}"
    kinds = {col: kind(str(t)) for col, t in zip(relation.columns, relation.types)}
    ours = {col: kind(t) for col, t in frame.dtypes}
    if kinds != ours:
        return "types " + str({col: (ours[col], kinds[col]) for col in columns if ours[col] != kinds[col]})
    position = [relation.columns.index(col) for col in columns]
    wanted = [tuple(plain(row[i]) for i in position) for row in relation.fetchall()]
    if Counter(rows) == Counter(wanted):
        return None if rows else "both empty"
    extra, missing = Counter(rows) - Counter(wanted), Counter(wanted) - Counter(rows)
    return f"rows {len(rows)} / {len(wanted)}; only ours {list(extra)[:2]}; only theirs {list(missing)[:2]}; {columns}"
