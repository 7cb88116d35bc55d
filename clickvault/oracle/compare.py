"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

The comparison mirrors the driver's: columns ordered by name, row count,
column types (coarse families) and an order-insensitive multiset of row
values. Used by the tests on small scale directories only.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck_connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(
            f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')"
        )
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float | decimal.Decimal):
        f = float(v)
        if math.isnan(f):
            return "nan"
        return f  # exact: both sides round to 2 places the same way
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


# Spark type -> the DuckDB type the oracle must produce for an exact match
EXACT = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def _family(type_name: str) -> str:
    t = type_name.lower()
    if any(k in t for k in ("int", "long", "short", "byte")):
        return "int"
    if any(k in t for k in ("double", "float", "decimal", "real")):
        return "float"
    if "timestamp" in t:
        return "timestamp"
    if "date" in t:
        return "date"
    if "bool" in t:
        return "bool"
    if "char" in t or "string" in t:
        return "string"
    return t


def run_pair(spark, con, query, sql: str, sf_dir: str):
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    return (s_cols, s_types, s_rows), (d_cols, d_types, d_rows)


def compare(
    spark, con, query, sql: str, sf_dir: str, strict_order: bool = False,
    exact_types: bool = False,
) -> tuple[bool, str]:
    (s_cols, s_types, s_rows), (d_cols, d_types, d_rows) = run_pair(
        spark, con, query, sql, sf_dir
    )
    if sorted(s_cols) != sorted(d_cols) or (strict_order and s_cols != d_cols):
        return False, f"columns differ: spark={s_cols} oracle={d_cols}"
    order = sorted(s_cols)
    if exact_types:
        bad_types = {c: (s_types[c], d_types[c]) for c in order
                     if EXACT.get(s_types[c], s_types[c]) != d_types[c]}
    else:
        bad_types = {c: (s_types[c], d_types[c]) for c in order
                     if _family(s_types[c]) != _family(d_types[c])}
    if bad_types:
        return False, f"types differ: {bad_types}"
    si = [s_cols.index(c) for c in order]
    di = [d_cols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in s_rows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in d_rows)
    if len(s_rows) != len(d_rows):
        return False, f"rows differ: spark={len(s_rows)} oracle={len(d_rows)}"
    if sc != dc:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        return False, f"values differ: spark-only={only_s} oracle-only={only_d}"
    return True, f"{len(s_rows)} rows"
