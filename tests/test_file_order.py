"""Codes granted in file order against a plain loop; running sums."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from unitmesh.operators import sites as S
from unitmesh.operators.numbering import running_sums


def loop(claims, held):
    now, out = dict(held), []
    for row, uid, code in sorted(claims):
        ok = code not in now.values()
        if ok:
            now[uid] = code
        out.append((row, ok))
    return out


def granted(spark, claims, held):
    c = spark.createDataFrame(claims, "row_no long, uid string, code string").repartition(4)
    return rows(S.codes_in_order(c, spark.createDataFrame(list(held.items()), "uid string, code string")), "row_no", "granted")


@pytest.mark.parametrize("seed", [1, 2])
def test_random_files(spark, seed):
    rng = random.Random(seed)
    held = {f"s{i}": f"c{i}" if rng.random() < 0.8 else None for i in range(12)}
    claims = [(r, f"s{rng.randrange(12)}", f"c{rng.randrange(16)}") for r in rng.sample(range(1000), 90)]
    assert granted(spark, claims, held) == sorted(loop(claims, held), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_chain_swap_and_one_code_wanted_by_all(spark):
    held = {"a": "A", "b": "B", "c": "C"}
    chain = [(1, "a", "X"), (2, "b", "A"), (3, "c", "B"), (4, "a", "C")]  # each takes what the one before freed
    swap = [(10, "a", "B"), (11, "b", "C"), (12, "a", "C")]
    assert granted(spark, chain, held) == [(1, True), (2, True), (3, True), (4, True)]
    assert granted(spark, swap, held) == [(10, False), (11, False), (12, False)]
    crowd = [(i, f"z{i}", "N") for i in range(60)] + [(100, "z0", "M"), (101, "z7", "N"), (102, "z8", "N"), (103, "a", "A")]
    assert dict(granted(spark, crowd, held)) == dict(loop(crowd, held))
    assert granted(spark, [], held) == []


def test_running_sums_of_a_hot_group(spark):
    rng = random.Random(5)
    data = [(0 if i % 3 else i % 7, i, rng.randrange(-3, 4)) for i in range(400)] + [(None, 1, 2), (None, 2, 5)]
    want = []
    for g in {d[0] for d in data}:
        total = 0
        for d in sorted(d for d in data if d[0] == g):
            want.append((g, d[1], total))
            total += d[2]
    got = running_sums(spark.createDataFrame(data, "g int, o int, v int"), ["g"], ["o"], "v", "s", partitions=5)
    assert set(map(tuple, got.select("g", "o", F.col("s").cast("int")).collect())) == set(want)
