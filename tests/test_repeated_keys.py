"""Rows alone under their key stay out of the shuffles of a merge and of the numbering of
the value table; many stage instances become a bitmap."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from unitmesh.operators import cascade as C
from unitmesh.operators import hierarchy as H
from unitmesh.operators import merge as M
from unitmesh.plans import fixtures as fx
from unitmesh.plans.joins import CONF_KEY, split_repeated
from unitmesh.plans.materialize import materialize
from unitmesh.schemas import DATAVALUE
from unitmesh.session import SCRATCH

NOW = "2024-06-30 12:00:00"
T = dt.datetime(2020, 1, 1)


def _written(spark, name, since):
    return [spark.read.parquet(p).count() for p in SCRATCH[since:] if f"unitmesh-{name}-" in p]


def _values(spark, n):
    """n keys of a row each and one key that both sites have."""
    mine = [(1, k, 10, 0, str(k), "u", T, None, False, 0, T, False) for k in range(n)]
    return spark.createDataFrame([*mine, (1, 5000, 10, 0, "1.5", "u", T, None, False, 0, T, False),
                                  (1, 5000, 11, 0, "2", "v", None, "c", True, 0, T, False)], DATAVALUE)


def _merged(spark, dv):
    elements = spark.createDataFrame([(1, "NUMBER")], "dataelementid int, valuetype string")
    pairs = spark.createDataFrame([(11, 10, "SUM")], "source_id int, dest_id int, strategy string")
    return M.merge_values(dv, elements, pairs, "SUM", NOW)


def test_single_rows_are_not_aggregated(spark):
    since = len(SCRATCH)
    res = _merged(spark, _values(spark, 50))
    assert _written(spark, "merge-keys", since) == [1]
    got = rows(res.staged, "periodid", "sourceid", "value", "storedby")
    assert got == sorted([(k, 10, str(k), "u") for k in range(50)] + [(5000, 10, "3.5", "admin")], key=lambda t: tuple(map(str, t)))


def test_too_many_repeated_keys_give_the_same_rows(spark):
    dv = _values(spark, 50)
    few = rows(_merged(spark, dv).staged)
    spark.conf.set(CONF_KEY, "1")
    try:
        since = len(SCRATCH)
        assert rows(_merged(spark, dv).staged) == few
        assert _written(spark, "merge-keys", since) == [51]
    finally:
        spark.conf.unset(CONF_KEY)


def test_repeated_keys_beyond_the_bound_leave_single_rows_out(spark):
    overlaps = [(1, 10000 + k, site, 0, str(k), "u", T, None, False, 0, T, False) for k in range(2000) for site in (10, 11)]
    dv = _values(spark, 500).unionByName(spark.createDataFrame(overlaps, DATAVALUE))
    few = rows(_merged(spark, dv).staged)
    spark.conf.set(CONF_KEY, "8400")  # 2,001 hashes take more, a bitmap of two blocks less
    try:
        since = len(SCRATCH)
        assert rows(_merged(spark, dv).staged) == few
        assert 2001 <= _written(spark, "merge-keys", since)[0] < 2501 - 400
    finally:
        spark.conf.unset(CONF_KEY)


def test_rows_split_by_a_bitmap_of_places(spark):
    df = spark.createDataFrame([(k % 3000, k) for k in range(5000)] + [(None, -1), (None, -2)], "k long, v long")
    spark.conf.set(CONF_KEY, "8400")
    try:
        shared, alone = split_repeated(df, F.when(F.col("k").isNotNull(), F.xxhash64("k")))
    finally:
        spark.conf.unset(CONF_KEY)
    assert rows(shared.unionByName(alone)) == rows(df)  # each row in one of the two
    assert {v for _, v in rows(alone)} <= {*range(2000, 3000), -1, -2}
    assert {-1, -2} <= {v for _, v in rows(alone)} and alone.count() > 900


def test_value_table_numbers_only_shared_keys(spark, tmp_path):
    day = lambda k: dt.datetime(1995, 1, 1 + k)
    lines = [(o, p, s, n, float(o or 0), 10.0 + (o or 0), 0.07, 0.0, "R", "F", day(d)) for o, p, s, n, d in (
        (1, 5, 1, 1, 0), (2, 6, 1, 3, 1), (3, 9, 1, 5, 1), (4, 10, 1, 1, 0), (53, 5, 1, 1, 0), (53, 5, 1, 1, 0),
        (None, 5, 2, 1, 0), (None, 5, 2, 1, 3), (5, None, 2, 1, 0), (6, None, 2, 1, 1), (7, 5, None, 2, 0), (8, 5, 3, None, 0))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                 "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    plain = spark.sql(fx.with_clause(["f_datavalue"], fx.spark_tables(str(tmp_path))) + "select * from f_datavalue")
    since = len(SCRATCH)
    got = fx.derive(spark, str(tmp_path), "f_datavalue")
    assert _written(spark, "repeated-rows", since) == [7]
    assert got.dtypes == plain.dtypes
    assert rows(got) == rows(plain)
    assert len(rows(fx.derive(spark, str(tmp_path), "f_long_value"))) == 10


def test_many_instances_are_probed_as_a_bitmap(spark):
    n = 20_000
    inst = materialize(spark.range(n).select(F.col("id").alias("programstageinstanceid"), F.lit(1).alias("organisationunitid")), "instances")
    values = spark.createDataFrame([(5, 1, 1.0), (n + 5, 1, 2.0), (None, 1, 3.0)], "programstageinstanceid long, dataelementid int, value double")
    units = spark.createDataFrame([(1, "A", None), (2, "B", None)], "organisationunitid int, uid string, parentid int")
    requests = materialize(spark.createDataFrame([("A",)], "uid string"), "requests")
    spark.conf.set(CONF_KEY, "16384")
    try:
        gone = C.delete_sites({"programstageinstance": inst, "trackedentitydatavalue": values, "organisationunit": units}, requests, units)
        left = gone.table("trackedentitydatavalue")
        plan = left._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
        assert rows(left) == [(n + 5, 1, 2.0), (None, 1, 3.0)]
        assert rows(gone.counts().where("table_name = 'trackedentitydatavalue'"), "deleted_rows") == [(1,)]
    finally:
        spark.conf.unset(CONF_KEY)


def test_units_pointed_to_are_told_before_the_shuffle(spark):
    n = 20_000
    live = materialize(spark.range(n).select(F.col("id").cast("int").alias("hop")), "live")
    rows_ = materialize(spark.createDataFrame([(5, "/a"), (n + 5, "/b"), (-3, "/c"), (None, "/d")], "hop int, piece string"), "rows")
    spark.conf.set(CONF_KEY, "16384")
    try:
        met = H._pointed_to(rows_, live)
        assert "SortMergeJoin" not in met._jdf.queryExecution().executedPlan().toString()
        assert rows(met) == [(5, "/a")]
    finally:
        spark.conf.unset(CONF_KEY)
