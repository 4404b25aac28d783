"""Plan-shape checks: the properties the operators are designed for at scale."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import functions as F

from unitmesh.operators import mapping as MP
from unitmesh.operators import merge as M
from unitmesh.operators import store as ST
from unitmesh.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_merge_uses_no_window(spark):
    res = M.merge_values(fx.load(spark, SF, "f_datavalue"), fx.load(spark, SF, "f_dataelement"),
                         fx.load(spark, SF, "f_merge_map"), "LAST", "2024-06-30 12:00:00")
    p = plan(res.staged)
    assert "Window" not in p
    assert "HashAggregate" in p or "SortAggregate" in p


def test_swap_is_a_broadcast_anti_join(spark):
    dv = fx.load(spark, SF, "f_datavalue")
    res = M.merge_values(dv, fx.load(spark, SF, "f_dataelement"), fx.load(spark, SF, "f_merge_map"),
                         "SUM", "2024-06-30 12:00:00")
    p = plan(M.replace_sites(dv, res.staged, res.sites))
    assert "BroadcastHashJoin LeftAnti" in p or ("BroadcastHashJoin" in p and "LeftAnti" in p)


def test_latest_per_key_is_an_aggregate(spark):
    ev = fx.raw(spark, SF, "events")
    store = ev.select(F.col("user_id").alias("key"), F.col("props").alias("document"), "ts",
                      F.col("event_id").alias("seq"))
    p = plan(ST.kv_latest(store))
    assert "Window" not in p and "partial_max" in p


def test_filters_and_columns_reach_the_scan(spark):
    ev = fx.raw(spark, SF, "events")
    p = plan(ev.where(F.col("event_type") == "click").select("event_id"))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in p
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in p
    members = spark.createDataFrame([("DS1", 1)], "dataset_id string, dataelementid int")
    units = spark.createDataFrame([(1001,)], "organisationunitid int")
    out = MP.data_values(fx.load(spark, SF, "f_datavalue"), members, "DS1", units, 1994, 1996)
    p = plan(out)
    assert "GreaterThanOrEqual(periodid,1994)" in p and "LessThanOrEqual(periodid,1996)" in p


def written_plans(monkeypatch, run) -> dict[str, str]:
    """Final plans of the tables the merge writes, by name."""
    found, real = {}, M.materialize

    def keep(df, name):
        df.collect()
        found[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)

    monkeypatch.setattr(M, "materialize", keep)
    run()
    return found


def test_merge_site_list_reaches_the_scan(spark, monkeypatch):
    found = written_plans(monkeypatch, lambda: M.merge_values(
        fx.load(spark, SF, "f_datavalue"), fx.load(spark, SF, "f_dataelement"), fx.load(spark, SF, "f_merge_map"), "SUM", "2024-06-30 12:00:00"))
    assert "In(sourceid," in found["merge-keys"] and "In(sourceid," in found["merge-overlaps"]


def test_merge_splits_a_hot_key(spark, monkeypatch):
    """Half of the rows share one key: aggregated without a join, or joined with skew=true."""
    from unitmesh.schemas import DATAELEMENT, DATAVALUE
    ts = F.lit("2020-01-01").cast("timestamp_ntz")
    dv = spark.range(200_000).select(
        F.lit(1).alias("dataelementid"), F.when(F.col("id") % 2 == 0, 2020).otherwise(F.col("id")).cast("int").alias("periodid"),
        (10 + F.col("id") % 4 / 2).cast("int").alias("sourceid"), F.lit(1).alias("categoryoptioncomboid"), F.col("id").cast("string").alias("value"),
        F.lit("u").alias("storedby"), ts.alias("lastupdated"), F.lit(None).cast("string").alias("comment"), F.lit(False).alias("followup"),
        F.lit(1).alias("attributeoptioncomboid"), ts.alias("created"), F.lit(False).alias("deleted")).select(*DATAVALUE.fieldNames())
    path = M.materialize(dv, "hot-values")
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "unitmesh.broadcast.maxBytes": "0",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k"}
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        elements = spark.createDataFrame([(1, "TEXT")], DATAELEMENT)
        found = written_plans(monkeypatch, lambda: M.merge_values(
            path, elements, spark.createDataFrame([(11, 10)], "source_id int, dest_id int"), "SUM", "2024-06-30 12:00:00"))
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in found["merge-overlaps"]


def test_size_checks_run_no_limit_job(spark):
    from unitmesh.plans.joins import is_small, plan_bytes
    big = spark.range(10 ** 9)
    assert not is_small(big) and plan_bytes(big) >= 8 * 10 ** 9 and is_small(spark.range(10))
