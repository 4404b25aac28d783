"""Top-k search against sorting all scores."""

from __future__ import annotations

import math
import random

from pyspark.sql import types as T

from unitmesh.llm import topk
from unitmesh.llm.topk import top_k

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("rank", T.StringType())])


def slow(rows, k, every):
    import struct
    as_float = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    ok = [(i, [math.floor(1024 * as_float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def result(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "mine") for i, v in rows], SCHEMA).repartition(5)
    return sorted(tuple(r) for r in top_k(df, **options).select("query_id", "rank", "vec_id", "score").collect())


def test_random_vectors_with_ties(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.25, 0.5, rng.random()]) for _ in range(6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(300)]  # a third of all rows share one vector
    monkeypatch.setattr(topk, "BINS", 8)  # several passes over scores and ids
    assert result(spark, rows, every=50) == slow(rows, 10, 50)
    assert result(spark, rows, every=50, query_block=3, k=4) == slow(rows, 4, 50)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (None, [1.0, 1.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]),
            (4, [float("inf"), 1.0]), (5, [1.0]), (6, []), (100, []), (7, [0.5, -0.5]), (200, [2.0]), (300, [1.0, 2.0, 3.0]),
            (-100, [0.1, 0.1])]
    assert result(spark, rows) == slow(rows, 10, 100)
    assert result(spark, []) == []
    assert result(spark, [(1, [1.0])]) == []
    twice = [(100, [1.0]), (5, [1.0]), (5, [1.0]), (6, [1.0])]
    assert result(spark, twice, k=2) == [(100, 1, 5, 1024 ** 2), (100, 2, 5, 1024 ** 2)]
