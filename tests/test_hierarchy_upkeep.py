"""Paths after changes against a full rebuild; interval labels against a plain walk."""

from __future__ import annotations

import random

import pytest

from tests.conftest import rows
from unitmesh.operators import hierarchy as H

UNITS = "organisationunitid int, uid string, parentid int"
COLS = ("organisationunitid", "uid", "parentid", "path", "level", "resolved")


def random_tree(rng, n):
    units = {i: (f"U{i}", rng.randrange(i) if i and rng.random() < 0.97 else None) for i in range(n)}
    for _ in range(n // 30):  # cycles and unknown parents
        i = rng.randrange(n)
        units[i] = (units[i][0], rng.choice([rng.randrange(n), i, 10_000 + i]))
    return units


def frame(spark, units):
    return spark.createDataFrame([(i, u, p) for i, (u, p) in units.items()], UNITS)


def written(spark, df, tmp_path, name):
    df.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


@pytest.mark.parametrize("seed", [1, 2])
def test_updates_equal_a_full_rebuild(spark, tmp_path, seed):
    rng = random.Random(seed)
    units = random_tree(rng, 300)
    paths = written(spark, H.materialize_paths(frame(spark, units)), tmp_path, "p")
    changed = {}
    for i in rng.sample(range(300), 25):
        kind = rng.random()
        changed[i] = (units[i][0], rng.randrange(300)) if kind < 0.6 else (f"N{i}", units[i][1]) if kind < 0.8 else (units[i][0], None)
    for i in range(400, 410):
        changed[i] = (f"U{i}", rng.randrange(410))
    gone = [i for i in rng.sample(range(300), 12) if i not in changed] + [9999]
    after = {**{i: u for i, u in units.items() if i not in gone}, **changed}
    updates = H.path_updates(paths, frame(spark, changed), spark.createDataFrame([(i,) for i in gone], "organisationunitid int"))
    got = H.apply_path_updates(paths, written(spark, updates, tmp_path, "u"))
    want = rows(H.materialize_paths(frame(spark, after)), *COLS)
    assert set(rows(got, *COLS)) ^ set(want) == set() and got.count() == len(want)


def test_only_touched_subtrees_are_written(spark, tmp_path):
    # a hundred chains of ten below one root; one unit in the middle of a chain moves
    units = {0: ("R", None)} | {1 + 10 * c + k: (f"U{c}_{k}", 10 * c + k if k else 0) for c in range(100) for k in range(10)}
    paths = written(spark, H.materialize_paths(frame(spark, units)), tmp_path, "p")
    moved = frame(spark, {1 + 6: ("U0_6", 1 + 10 * 50)})
    updates = H.path_updates(paths, moved)
    assert sorted(r["uid"] for r in updates.collect()) == ["U0_6", "U0_7", "U0_8", "U0_9"]
    assert {r["uid"]: r["path"] for r in updates.collect()}["U0_7"] == "/R/U50_0/U0_6/U0_7"


def test_nothing_changed_and_empty_tables(spark, tmp_path):
    paths = written(spark, H.materialize_paths(frame(spark, {1: ("A", None), 2: ("B", 1)})), tmp_path, "p")
    none = spark.createDataFrame([], UNITS)
    assert H.path_updates(paths, none).count() == 0
    empty = written(spark, H.materialize_paths(none), tmp_path, "e")
    assert rows(H.path_updates(empty, frame(spark, {1: ("A", None)})), "path") == [("/A",)]
    assert H.interval_labels(none).count() == 0


def test_labels_and_ranges_equal_a_walk(spark, tmp_path):
    rng = random.Random(7)
    units = random_tree(rng, 250)
    children = {}
    for i, (_, p) in units.items():
        children.setdefault(p, []).append(i)
    walk, last = [], {}

    def visit(i, level):
        walk.append((i, level))
        for c in sorted(children.get(i, [])):
            visit(c, level + 1)
        last[i] = len(walk)

    for root in sorted(children[None]):
        visit(root, 1)
    labels = written(spark, H.interval_labels(frame(spark, units)), tmp_path, "l")
    assert rows(labels, "organisationunitid", "level", "first", "last") == sorted(
        ((i, level, k + 1, last[i]) for k, (i, level) in enumerate(walk)), key=lambda t: tuple((x is None, str(x)) for x in t))
    roots = spark.createDataFrame([(f"U{i}",) for i in rng.sample(range(250), 40)] + [("none",), (None,)], "uid string")
    want = rows(H.descendants(H.materialize_paths(frame(spark, units)), roots))
    assert rows(H.descendants_range(labels, roots)) == want
    old, H.MAX_RANGES = H.MAX_RANGES, 3  # too many intervals for a filter
    try:
        assert rows(H.descendants_range(labels, roots)) == want
    finally:
        H.MAX_RANGES = old


def test_ranges_reach_the_scan(spark, tmp_path):
    labels = written(spark, H.interval_labels(frame(spark, {0: ("R", None)} | {i: (f"U{i}", 0) for i in range(1, 50)})), tmp_path, "l")
    plan = H.descendants_range(labels, spark.createDataFrame([("R",)], "uid string"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(first,1)" in plan and "LessThanOrEqual(first,50)" in plan
