"""Runs a registered query in Spark and in DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return repr(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


# Spark's names for the types where DuckDB's differ.
_TYPE_NAMES = {"int": "integer", "string": "varchar"}


def differences(spark, db, query, sql, sf_dir) -> tuple[int, list[str]]:
    """The row count and what differs (nothing, when the two agree)."""
    frame = query(spark, sf_dir)
    mine = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _rows(names, cursor.fetchall())
    found = []
    if sorted(names) != sorted(frame.columns):
        found.append(f"columns {sorted(frame.columns)} against {sorted(names)}")
    types = {name: _TYPE_NAMES.get(kind, kind) for name, kind in frame.dtypes}
    their_types = {d[0]: str(d[1]).lower() for d in cursor.description}
    if types != their_types:
        found.append(f"types {types} against {their_types}")
    if len(mine) != len(theirs):
        found.append(f"{len(mine)} rows against {len(theirs)}")
    if mine != theirs:
        only_mine = sorted(set(mine) - set(theirs))
        only_theirs = sorted(set(theirs) - set(mine))
        found.append(f"only Spark {only_mine[:3]}, only DuckDB {only_theirs[:3]}")
    return len(mine), found
