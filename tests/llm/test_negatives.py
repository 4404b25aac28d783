"""Hard negatives against scoring and sorting all pairs."""

from __future__ import annotations

import math
import random
import struct

import numpy as np
from pyspark.sql import types as T

from unitmesh.llm import negatives as N
from unitmesh.llm.negatives import hard_negatives

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("rank", T.StringType()), T.StructField("_q", T.LongType())])


def slow(rows, every=100):
    as_float = lambda x: struct.unpack("f", struct.pack("f", x))[0]
    ok = [(i, [math.floor(256 * as_float(x)) for x in v], (n + 1) % 10 if i % 7 == 0 else n) for i, v, n in rows
          if i is not None and v is not None and n is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a, n in ok:
        if q % every:
            continue
        score = [(sum(x * y for x, y in zip(a, b)), i, m) for i, b, m in ok if i != q and len(b) == len(a)]
        for ps, pid, _ in sorted((s for s in score if s[2] == n), key=lambda s: (-s[0], s[1]))[:5]:
            fit = sorted((s for s in score if s[2] != n and 30 * ps <= 100 * s[0] <= 90 * ps), key=lambda s: (-s[0], s[1]))[:10]
            out += [(q, pid, k + 1, s[1], ps, s[0]) for k, s in enumerate(fit)]
    return sorted(out)


def result(spark, rows, parts=5, **options):
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA).repartition(parts)
    got = hard_negatives(df, **options)
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def clustered(rng, n, d, groups=10, noise=0.5):
    middle = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(groups)]
    return [(i, [x + rng.gauss(0, noise) for x in middle[i % groups]], rng.choice([i % groups, rng.randrange(10)])) for i in range(n)]


def test_clusters_of_several_dimensions(spark):
    rng = random.Random(3)
    rows = clustered(rng, 600, 8) + [(i + 1000, v, n) for i, v, n in clustered(rng, 300, 70)] + [(i + 5000, [], i % 3) for i in range(0, 120, 20)]
    assert result(spark, rows) == slow(rows)


def test_ties_and_rows_that_take_no_part(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice([-0.5, 0.5, 1.0]) for _ in range(4)], rng.randrange(3)) for i in range(400)]
    rows += [(None, [1.0] * 4, 1), (2000, None, 1), (2100, [1.0, None, 1.0, 1.0], 1), (2200, [1.0, float("nan"), 0.0, 0.0], 1),
             (2300, [float("inf")] * 4, 1), (2400, [1.0] * 4, None), (2500, [0.0] * 4, 1), (2600, [-1.0] * 4, 9)]
    assert result(spark, rows) == slow(rows)


def test_one_label_holds_a_third_and_copies_share_a_vector(spark):
    rng = random.Random(6)
    rows = [(i, [0.25, 0.5, -0.5], 4) if i % 3 == 0 else (i, [rng.uniform(-1, 1) for _ in range(3)], rng.randrange(10)) for i in range(900)]
    assert result(spark, rows) == slow(rows)


def test_several_blocks_and_parts(spark, monkeypatch):
    rng = random.Random(8)
    rows = clustered(rng, 800, 6)
    monkeypatch.setattr(N, "ROWS_PER_BATCH", 64)
    assert result(spark, rows, block_bytes=400) == slow(rows)


def test_repeated_ids_and_empty_tables(spark):
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (101, [1.0, 0.5], 1), (102, [0.5, 0.5], 2)]
    assert set(result(spark, rows)) == set(slow(rows))
    assert result(spark, []) == []
    assert result(spark, [(1, [1.0], 1)]) == [] and result(spark, [(100, [1.0], 1)]) == []


def test_intervals_hold_the_score_and_skip_most_pairs():
    rng = np.random.default_rng(2)
    middle = rng.standard_normal((10, 64))
    label = rng.integers(0, 10, 4000)
    rows = np.floor(256 * (middle[label] + 0.4 * rng.standard_normal((4000, 64))) / 9).astype(np.int64)
    of_rows = N.encode(rows)
    a = N.Anchors(np.arange(50), np.arange(50), label[:50], rows[:50])
    low, high = a.intervals(*of_rows)
    score = rows[:50] @ rows.T
    assert (low <= score).all() and (score <= high).all()
    fifth = np.sort(score, axis=1)[:, -6]
    assert (high >= fifth[:, None]).mean() < 0.2
