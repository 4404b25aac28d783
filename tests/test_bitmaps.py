"""Key bitmaps against semi- and anti-joins."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from unitmesh.plans.bitmaps import KeyBitmap

EDGES = [0, 1, -1, 7, 8, 63, 64, 65, 32767, 32768, 32769, 65536, -32768, -32769, 2**31 - 1, -2**31]


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_equal_to_joins(spark, max_bytes):
    rng = random.Random(1)
    keys = spark.createDataFrame([(k,) for k in EDGES[::2] + [rng.randrange(200_000) for _ in range(3000)] + [None, 5, 5]], "id int")
    big = spark.createDataFrame([(k, i) for i, k in enumerate(EDGES + [rng.randrange(200_000) for _ in range(5000)] + [None])], "sourceid long, n int")
    k = KeyBitmap(keys, "id", max_bytes)
    assert k.fits == (max_bytes is None)
    on = keys.select(F.col("id").cast("long").alias("sourceid")).where("id is not null").distinct()
    assert rows(k.matching(big, "sourceid")) == rows(big.join(on, "sourceid", "left_semi").select("sourceid", "n"))
    assert rows(k.without(big, "sourceid")) == rows(big.join(on, "sourceid", "left_anti").select("sourceid", "n"))


def test_a_million_keys_are_small_and_nothing_shuffles(spark, tmp_path):
    keys = KeyBitmap(spark.range(1_000_000).select((F.col("id") * 2).alias("id")), "id")
    assert keys.fits and keys.bytes < 300_000
    spark.range(0, 3_000_000).withColumn("v", F.lit(1)).write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    kept = keys.without(big, "id")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert kept.count() == 2_000_000 and keys.matching(big, "id").agg(F.max("id")).first()[0] == 1_999_998


def test_empty_keys_and_other_types(spark):
    none = KeyBitmap(spark.createDataFrame([], "id int"), "id")
    assert none.without(spark.range(5), "id").count() == 5 and none.matching(spark.range(5), "id").count() == 0
    with pytest.raises(ValueError):
        KeyBitmap(spark.createDataFrame([("a",)], "id string"), "id")
