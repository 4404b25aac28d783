"""Compare a Spark result with its DuckDB oracle on the same parquet tables.

Used by the tests: row count, column names and an order-insensitive multiset of
normalised rows (columns sorted by name, floats rounded, nested values as JSON).
Only for test-scale data; it collects both results.
"""

from __future__ import annotations

import datetime as _dt
import decimal
import json
from collections import Counter

from pyspark.sql import DataFrame

from unitmesh.plans.fixtures import RAW_TABLES
from unitmesh.session import table_path


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return json.dumps([_norm(x) for x in v], default=str)
    if isinstance(v, dict):
        return json.dumps({k: _norm(x) for k, x in v.items()}, default=str, sort_keys=True)
    if hasattr(v, "asDict"):
        return _norm(v.asDict(recursive=True))
    return v


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(df: DataFrame, sql: str, con) -> dict:
    cols = sorted(df.columns)
    spark_rows = [tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    ocols = sorted(names)
    idx = [names.index(c) for c in ocols]
    oracle_rows = [tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()]
    a, b = Counter(spark_rows), Counter(oracle_rows)
    return {
        "rows_spark": len(spark_rows),
        "rows_oracle": len(oracle_rows),
        "columns_match": cols == ocols,
        "spark_columns": cols,
        "oracle_columns": ocols,
        "values_match": a == b,
        "only_spark": list((a - b).elements())[:5],
        "only_oracle": list((b - a).elements())[:5],
    }
