"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from unitmesh.plans import all_queries
from unitmesh.plans.check import compare, duckdb_connection

SF = "/root/testdata/sf0.001"
NAMES = sorted(all_queries.REGISTRY)


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    r = compare(df, oracle_sql()[name], con)
    assert r["columns_match"], (r["spark_columns"], r["oracle_columns"])
    assert r["rows_spark"] == r["rows_oracle"]
    assert r["values_match"], (r["only_spark"], r["only_oracle"])


def test_entry_smoke(spark):
    from unitmesh.schemas import DATAVALUE

    df = entry(spark)
    assert df.count() > 0
    assert [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in DATAVALUE.fields]
