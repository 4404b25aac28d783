"""Prefix index against the search without one."""

from __future__ import annotations

import random

import pytest

from conftest import rows
from unitmesh.operators import lookup as L

ALPHABET = ["a", "B", "b", "z", "퟿", "", "\U0010ffff", "é", "#", "~"]


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    rng = random.Random(4)
    text = lambda: "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(5)))
    df = spark.createDataFrame([(i, text() if i % 9 else None, [text(), text(), None] if i % 5 else None) for i in range(2000)], "id int, code string, names array<string>")
    path = str(tmp_path_factory.mktemp("index") / "i")
    L.prefix_index(df, ["code", "names"], ["id"]).write.parquet(path)
    return df, spark.read.parquet(path)


@pytest.mark.parametrize("prefix", ["", "a", "B", "b#", "퟿", "", "\U0010ffff", "\U0010ffff\U0010ffff", "zz~", "é", "none"])
def test_equal_to_the_search_without_an_index(both, prefix):
    df, index = both
    assert rows(L.prefix_search(index, prefix)) == rows(L.code_search(df, prefix, ["code", "names"], ["id"]))


def test_the_range_reaches_the_scan(both):
    plan = L.prefix_search(both[1], "Ab")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lowered,ab)" in plan and "LessThan(lowered,ac)" in plan
    assert L.after_prefix("") is None and L.after_prefix("a\U0010ffff") == "b"
