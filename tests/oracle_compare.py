"""Run a contract query on Spark and its oracle on DuckDB and compare the results.

Columns are matched by name; rows are compared as multisets after normalising values
(doubles rounded to 9 significant digits, NaN kept as a token, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        if v == 0:
            return 0.0
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return _norm(float(v))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [tuple(_norm(r[i]) for i in order) for r in records]


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = rows_of(s_cols, [tuple(r) for r in df.collect()])
    con = con or duck(sf_dir)
    res = con.execute(entry.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    o_rows = rows_of(o_cols, res.fetchall())
    out = {
        "name": name,
        "spark_rows": len(s_rows),
        "oracle_rows": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
        "spark_columns": s_cols,
        "oracle_columns": o_cols,
    }
    sc, oc = Counter(s_rows), Counter(o_rows)
    out["values_match"] = out["columns_match"] and sc == oc
    if not out["values_match"]:
        out["only_spark"] = list((sc - oc).elements())[:5]
        out["only_oracle"] = list((oc - sc).elements())[:5]
    return out
