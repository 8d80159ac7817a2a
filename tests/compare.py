"""Run a query and its SQL twin on the same files and compare them exactly."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
         "boolean": "BOOLEAN"}


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def diff(df, con, sql: str) -> list[str]:
    """Problems found; empty when schema and rows agree."""
    cur = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in cur.description}
    names = sorted(want_types)
    out = []
    if sorted(df.columns) != names:
        return [f"columns: spark {sorted(df.columns)} twin {names}"]
    for field in df.schema.fields:
        got = TYPES.get(field.dataType.simpleString(), field.dataType.simpleString())
        if got != want_types[field.name]:
            out.append(f"type of {field.name}: spark {got} twin {want_types[field.name]}")
    order = [d[0] for d in cur.description]
    want = Counter(tuple(_plain(r[order.index(n)]) for n in names) for r in cur.fetchall())
    got = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    if got != want:
        out.append(f"rows: spark {sum(got.values())} twin {sum(want.values())}; "
                   f"only spark {sum((got - want).values())} only twin {sum((want - got).values())}")
        out.append(f"  {names}")
        out += [f"  spark {r}" for r in sorted((got - want), key=str)[:3]]
        out += [f"  twin  {r}" for r in sorted((want - got), key=str)[:3]]
    elif not got:
        out.append("EMPTY result on both sides")
    return out


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
