"""Compare a registered query with its DuckDB oracle (row count, columns, values)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_connection(sf_dir: str):
    import duckdb  # noqa: PLC0415 -- test/verification dependency only

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in DRIVER_TABLES:
        p = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def normalize(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _sort_key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@dataclass
class Outcome:
    name: str
    ok: bool
    rows: int
    detail: str = ""


def compare(spark: SparkSession, con, name: str, sf_dir: str, builders: dict, sqls: dict) -> Outcome:
    df = builders[name](spark, sf_dir)
    cols = df.columns
    srows = [tuple(normalize(r[c]) for c in cols) for r in df.collect()]
    if name not in sqls:
        return Outcome(name, True, len(srows), "no oracle")
    cur = con.execute(sqls[name])
    ocols = [d[0] for d in cur.description]
    if sorted(cols) != sorted(ocols):
        return Outcome(name, False, len(srows),
                       f"columns: spark-only {sorted(set(cols) - set(ocols))} oracle-only {sorted(set(ocols) - set(cols))}")
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(normalize(r[i]) for i in idx) for r in cur.fetchall()]
    if len(srows) != len(orows):
        return Outcome(name, False, len(srows), f"rows: spark={len(srows)} oracle={len(orows)}")
    diffs = [(x, y) for x, y in zip(sorted(srows, key=_sort_key), sorted(orows, key=_sort_key)) if x != y]
    if diffs:
        x, y = diffs[0]
        first = {c: (a, b) for c, a, b in zip(cols, x, y) if a != b}
        return Outcome(name, False, len(srows), f"{len(diffs)} rows differ; first (spark, oracle): {first}")
    return Outcome(name, True, len(srows))
