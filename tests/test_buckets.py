"""Stored tables in buckets: only touched buckets are rewritten; streams into a store."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from unitmesh.operators import buckets as B
from unitmesh.operators.store import kv_latest
from unitmesh.streaming.latest_store import apply_versions, create_store, read_store, run_latest_store

SCHEMA = "sourceid int, value string"
VERSIONS = "key string, document string, ts timestamp_ntz, seq bigint"


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def table(spark, tmp_path):
    path = tmp_path / "dv"
    df = spark.createDataFrame([(i % 40, f"v{i}") for i in range(400)] + [(None, "n")], SCHEMA)
    B.write_buckets(df, str(path), "sourceid", 16)
    return df, path


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    df, path = table(spark, tmp_path)
    before = files(path)
    staged = spark.createDataFrame([(7, "merged")], SCHEMA)
    sites = spark.createDataFrame([(7,), (9,)], "sourceid int")
    at = B.replace_sites_stored(spark, str(path), df.schema, staged, sites, 16)
    assert len(at) <= 2
    after = files(path)
    kept = {f for f in before if int(f.split("bucket=")[1].split("/")[0]) not in at}
    assert kept and all(after[f] == before[f] for f in kept)
    want = rows(df.where("sourceid is null or sourceid not in (7, 9)").unionByName(staged))
    assert rows(B.read_buckets(spark, str(path), df.schema), "sourceid", "value") == want
    B.replace_sites_stored(spark, str(path), df.schema, staged, sites, 16)  # run again: the same store
    assert rows(B.read_buckets(spark, str(path), df.schema), "sourceid", "value") == want


def test_reads_of_some_keys_open_their_buckets_only(spark, tmp_path):
    df, path = table(spark, tmp_path)
    got = B.read_buckets(spark, str(path), df.schema, spark.createDataFrame([(3,)], "sourceid int"), "sourceid", 16)
    plan = got._jdf.queryExecution().executedPlan().toString()
    at = B.touched_buckets(spark.createDataFrame([(3,)], "sourceid int"), "sourceid", 16)
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "bucket#" in filters and str(at[0]) in filters
    assert {r[0] for r in got.select(B.BUCKET).distinct().collect()} == set(at) and got.where("sourceid = 3").count() == 10


def test_deletes_and_emptied_buckets(spark, tmp_path):
    df, path = table(spark, tmp_path)
    gone = spark.createDataFrame([(i,) for i in range(30)] + [(999,), (None,)], "sourceid int")
    B.delete_keys_stored(spark, str(path), df.schema, gone, "sourceid", 16)
    assert rows(B.read_buckets(spark, str(path), df.schema), "sourceid", "value") == rows(df.where("sourceid is null or sourceid >= 30"))
    B.delete_keys_stored(spark, str(path), df.schema, spark.createDataFrame([(i,) for i in range(40)], "sourceid int"), "sourceid", 16)
    assert rows(B.read_buckets(spark, str(path), df.schema), "sourceid", "value") == [(None, "n")]
    assert B.delete_keys_stored(spark, str(path), df.schema, gone.limit(0), "sourceid", 16) == []


def versions(spark, rng, n, start):
    data = [(rng.choice(["a", "b", "c", None, "d", f"k{rng.randrange(20)}"]), f"d{rng.randrange(99)}",
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randrange(30)), start + i) for i in range(n)]
    return spark.createDataFrame(data, VERSIONS)


def test_stream_equals_the_latest_of_all_versions_also_when_replayed(spark, tmp_path):
    rng = random.Random(3)
    path, source, ckpt = (str(tmp_path / n) for n in ("store", "in", "ck"))
    create_store(spark, path, VERSIONS, 8)
    assert read_store(spark, path, VERSIONS).count() == 0
    loads = [versions(spark, rng, 60, k * 100) for k in range(3)]
    for load in loads:
        load.write.mode("append").parquet(source)
        run_latest_store(spark, source, VERSIONS, path, ckpt, 8)
    everything = loads[0].unionByName(loads[1]).unionByName(loads[2]).where("key is not null")
    want = rows(kv_latest(everything).select("key", "document", "ts", "seq"))
    assert rows(read_store(spark, path, VERSIONS)) == want
    apply_versions(loads[0], path, VERSIONS, 8)  # an old batch once more
    run_latest_store(spark, source, VERSIONS, path, str(tmp_path / "ck2"), 8)  # and all of them, the checkpoint lost
    assert rows(read_store(spark, path, VERSIONS)) == want
    one = spark.createDataFrame([("a", "new", dt.datetime(2025, 1, 1), 1)], VERSIONS)
    assert len(apply_versions(one, path, VERSIONS, 8)) == 1
    assert read_store(spark, path, VERSIONS).where(F.col("key") == "a").first()["document"] == "new"
