"""Fuzzy name join against scoring every pair; the vectorised Jaro against a plain loop."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from unitmesh.functions import jaro as J
from unitmesh.functions.jaro import jaro, jaro_many
from unitmesh.operators import fuzzy
from unitmesh.operators.fuzzy import fuzzy_matches, fuzzy_pairs, prefix_rows


def plain(a, b):
    if not a or not b:
        return 0.0
    w = max(max(len(a), len(b)) // 2 - 1, 0)
    free, order_a = [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - w), min(len(b), i + w + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                order_a.append(c)
                break
    m = len(order_a)
    if not m:
        return 0.0
    t = sum(x != y for x, y in zip(order_a, [b[j] for j in range(len(b)) if not free[j]])) // 2
    return (m / len(a) + m / len(b) + (m - t) / m) / 3


def names(rng, n, alphabet="abcdeé ", longest=14):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, longest))) for _ in range(n)]


def test_vectorised_jaro_equals_the_loop():
    rng = random.Random(1)
    a, b = names(rng, 4000), names(rng, 4000)
    a += ["martha", "x" * 3000, "a", "", "\U0001f600b", "\x00a"]
    b += ["marhta", "x" * 2990 + "y" * 20, "a", "b", "b\U0001f600", "a\x00"]
    assert list(jaro_many(a, b)) == [plain(x, y) for x, y in zip(a, b)]
    assert jaro(None, "a") is None and jaro("martha", "marhta") == pytest.approx(0.944444, abs=1e-6)


@pytest.mark.parametrize("threshold", [50.0, 66.0, 80.0, 90.0, 100.0])
def test_equal_to_all_pairs(spark, threshold):
    rng = random.Random(int(threshold))
    left, right = names(rng, 150) + [None, "", "only"], names(rng, 150) + [None, "", "only", "only"]
    left += [r[:-1] for r in right[:40] if r]
    want = {(a, b, round(plain(a, b) * 100, 6)) for a in set(left) for b in set(right) if a and b and round(plain(a, b) * 100, 6) >= threshold}
    ldf, rdf = (spark.createDataFrame([(x,) for x in v], "n string") for v in (left, right))
    got = [tuple(r) for r in fuzzy_pairs(ldf, rdf, "n", "n", threshold).collect()]
    assert len(got) == len(set(got))
    assert {(a, b, round(v, 5)) for a, b, v in got} == {(a, b, round(v, 5)) for a, b, v in want}


def test_hot_tokens_in_tiles_and_few_candidates(spark, monkeypatch):
    monkeypatch.setattr(fuzzy, "TILE", 16)
    rng = random.Random(9)
    words = ["clinic", "health", "centre", "north", "south", "mission", "district", "general", "rural", "post"]
    left = [f"{rng.choice(words)} {rng.choice(words)} {rng.randrange(300)}" for _ in range(300)]
    right = [f"{rng.choice(words)} {rng.choice(words)} {rng.randrange(300)}" for _ in range(300)]
    ldf, rdf = (spark.createDataFrame([(x,) for x in v], "n string") for v in (left, right))
    got = {tuple(r)[:2] for r in fuzzy_pairs(ldf, rdf, "n", "n", 90.0).collect()}
    assert got == {(a, b) for a in left for b in right if round(plain(a, b) * 100, 6) >= 90}
    both = spark.createDataFrame([(0, k, x) for k, x in enumerate(set(left))] + [(1, 1000 + k, x) for k, x in enumerate(set(right))], "side int, nid long, name string")
    met = prefix_rows(both, 90.0).groupBy("token", "ca", "cb").agg(F.sum("side").alias("r"), F.sum(1 - F.col("side")).alias("l"))
    assert met.agg(F.sum(F.col("l") * F.col("r"))).first()[0] < 0.3 * len(set(left)) * len(set(right))


def test_long_names_in_classes(spark):
    rng = random.Random(4)
    left = [x for n in (30, 33, 50, 80, 200, 400) for x in names(rng, 12, "abcdefgh", n) if x]
    right = [x[:len(x) * 9 // 10] for x in left] + [x[1:] + "zz" for x in left] + [x + x[:len(x) // 4] for x in left]
    ldf, rdf = (spark.createDataFrame([(x,) for x in v], "n string") for v in (left, right))
    for t in (75.0, 92.0):
        got = {tuple(r)[:2] for r in fuzzy_pairs(ldf, rdf, "n", "n", t).collect()}
        assert got == {(a, b) for a in left for b in right if b and round(plain(a, b) * 100, 6) >= t}


def test_best_match_ties_and_extra_columns(spark):
    left = spark.createDataFrame([(1, "abcd", "x"), (2, "zzzz", "x"), (3, None, "x"), (4, "abcd", "y"), (5, "same", None)], "k int, n string, matched_note string")
    right = spark.createDataFrame([("b2", "abce"), ("b1", "abce"), ("c", "abcf"), ("s", "same"), (None, None)], "id string, name string")
    got = {r["k"]: (r["matched_name"], r["matched_id"], r["n_similar"], r["matched"]) for r in fuzzy_matches(left, right, "n", "name", "id", 80.0).collect()}
    assert got == {1: ("abce", "b1", 2, False), 4: ("abce", "b1", 2, False), 2: (None, None, 0, False), 3: (None, None, 0, False), 5: ("same", "s", 1, True)}


def test_empty_sides(spark):
    none = spark.createDataFrame([], "n string")
    some = spark.createDataFrame([("a",)], "n string")
    assert fuzzy_pairs(none, some, "n", "n").count() == 0 and fuzzy_pairs(some, none, "n", "n").count() == 0
    with pytest.raises(ValueError):
        fuzzy_pairs(some, some, "n", "n", 0)


def test_blocks_of_one_window_and_of_several():
    rng = random.Random(3)
    for n, longest, alphabet in ((3000, 40, "abcde "), (40, 300, "abc"), (500, 20, "aé\U0001f600中")):
        a, b = names(rng, n, alphabet, longest), names(rng, n, alphabet, longest)
        assert list(jaro_many(a, b)) == [plain(x, y) for x, y in zip(a, b)]


def test_pairs_scored_at_once_are_of_like_length(monkeypatch):
    rng = random.Random(5)
    a, b = names(rng, 6000, "abcde ", 40), names(rng, 6000, "abcde ", 40)
    block, sizes = J._jaro_block, []

    def seen(left, right):
        sizes.append([max(len(x), len(y), 1) for x, y in zip(left, right)])
        return block(left, right)

    monkeypatch.setattr(J, "_jaro_block", seen)
    assert list(jaro_many(a, b)) == [plain(x, y) for x, y in zip(a, b)]
    assert sum(map(len, sizes)) == 6000
    assert sum(max(s) * len(s) for s in sizes) < 1.2 * sum(map(sum, sizes))
