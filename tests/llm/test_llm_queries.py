"""The registered queries: whole results, and the DuckDB SQL of those that have it."""

from __future__ import annotations

import pytest

from __spark_entry__ import oracle_sql, queries
from unitmesh.llm.queries import ORACLES, QUERIES
from unitmesh.plans.check import compare, duckdb_connection

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 11))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    r = compare(queries()[name](spark, SF), oracle_sql()[name], duckdb_connection(SF))
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["values_match"], (r["only_spark"], r["only_oracle"])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_result_for_each_document(spark, name):
    df = queries()[name](spark, SF)
    ids = [r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    got = [r["doc_id"] for r in df.collect()]
    assert set(got) == set(ids) and (name == "op7_packing" or len(got) == len(ids))
