"""Run registered queries against their DuckDB oracles and print one line each.

    python tests/run_oracle.py [--plain] [sf_dir] [name ...]

``--plain`` uses a bare SparkSession (none of the engine's settings), as the
driver's correctness check does.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from unitmesh import build_session  # noqa: E402
from unitmesh.plans.check import compare, duckdb_connection  # noqa: E402


def main(argv):
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    if plain:
        from pyspark.sql import SparkSession

        spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session("local[8]", 8)
    con = duckdb_connection(sf)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if name in sqls:
                r = compare(df, sqls[name], con)
                ok = r["values_match"] and r["columns_match"]
                extra = "" if ok else f" cols={r['spark_columns']} vs {r['oracle_columns']} only_spark={r['only_spark'][:2]} only_oracle={r['only_oracle'][:2]}"
                print(f"{'OK ' if ok else 'BAD'} {name}: spark={r['rows_spark']} oracle={r['rows_oracle']} {time.time()-t0:.1f}s{extra}", flush=True)
                bad += not ok
            else:
                n = df.count()
                print(f"RUN {name}: rows={n} (no oracle) {time.time()-t0:.1f}s", flush=True)
        except Exception as e:  # report and continue
            bad += 1
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
