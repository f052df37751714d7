"""Run a query in Spark and its twin in DuckDB and compare whole results."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def _rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in records]
    return sorted(columns), sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


def compare(spark, sf_dir, query, sql) -> list[str]:
    """Differences between the two results, empty when they agree."""
    df = query(spark, sf_dir)
    con = connect(sf_dir)
    relation = con.sql(sql)
    problems = []
    ours = {f.name: f.dataType.simpleString() for f in df.schema}
    theirs = {c: KINDS.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    if ours != theirs:
        problems.append(f"schema {sorted(ours.items())} != {sorted(theirs.items())}")
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(relation.columns, relation.fetchall())
    if got[0] != want[0]:
        problems.append("column names differ")
    if len(got[1]) != len(want[1]):
        problems.append(f"{len(got[1])} rows, expected {len(want[1])}")
    if got[1] != want[1]:
        extra = set(got[1]) - set(want[1])
        missing = set(want[1]) - set(got[1])
        problems.append(f"values: extra {list(extra)[:3]} missing {list(missing)[:3]}")
    if not got[1]:
        problems.append("no rows at all")
    return problems
