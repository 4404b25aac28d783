"""Merkle manifest against a plain recursive version."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitmesh.llm.merkle import leaf_of, manifest, proofs
from tests.llm.conftest import DOCS


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """The last node of a tree and each node's siblings, level by level."""
    sides = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for lo in range(0, len(nodes), 16):
            run = nodes[lo:lo + 16]
            for p in range(len(run)):
                for i in under[lo + p]:
                    sides[i].append((run[:p], run[p + 1:]))
            up.append(h(*run))
            held.append([i for p in range(len(run)) for i in under[lo + p]])
        nodes, under = up, held
    return nodes[0], sides


def slow(rows):
    """rows: (doc_id, text, lang, source, n_chars)"""
    fields = lambda r, t: (r[0], r[3], r[2], r[4], t)
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = []
    for s in names:
        rs = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(fields(r, r[1]))))
        made.append((rs, *climb([leaf(fields(r, r[1])) for r in rs])))
    root, top = climb([sub for _, sub, _ in made])
    out = []
    for (rs, sub, sides), above in zip(made, top):
        for r, own in zip(rs, sides):
            path = own + above
            t = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and t is not None:
                t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
            f = leaf(fields(r, t))
            for left, right in path:
                f = h(*left, f, *right)
            out.append((r[0], leaf(fields(r, r[1])), sub, root, h(*[x for a, b in path for x in a + b]), f, f == root))
    return sorted(out, key=str)


def result(spark, rows, parts=3):
    df = spark.createDataFrame(rows, DOCS).repartition(parts).withColumn("leaf", F.lit("mine")).withColumn("k", F.lit(1))
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = manifest(df, {"text": low}, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    return sorted((tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def test_deep_and_uneven_trees(spark):
    rows = [(i, f"Text {i} Été" if i % 9 else None, "en", "hot" if i % 3 else f"s{i % 90}", i) for i in range(1500)]
    assert result(spark, rows) == slow(rows)


def test_nulls_repeats_and_lone_leaves(spark):
    rows = [(None, None, None, None, None), (None, "A", None, None, None), (None, "A", None, None, None), (3, "", "", "", 0),
            (3, "B", "x", "", None), (5, "B" * 30000, "x", "lone", 2), (5, "B", "x", "é", 2), (7, "c", "x", "zz", 1), (7, "c", "x", "zz", 1)] + [(i, "Up", "x", "s", 1) for i in range(20, 40)]
    assert result(spark, rows) == slow(rows)
    got = result(spark, rows)
    assert not all(r[6] for r in got) and any(r[6] for r in got)


@pytest.mark.parametrize("n", [1, 2, 16, 17, 256, 257])
def test_one_group_of_any_size(spark, n):
    rows = [(i, str(i), "en", "s", 1) for i in range(n)]
    assert result(spark, rows) == slow(rows)


def test_many_lone_groups(spark):
    rows = [(i, "Same", "en", f"s{i:03d}", 1) for i in range(40)]
    assert result(spark, rows) == slow(rows)


def test_empty_table(spark):
    assert result(spark, []) == []


def test_proofs_keep_other_columns_and_layout_does_not_matter(spark):
    rows = [(i // 2, f"t{i}", "en", f"s{i % 3}", i) for i in range(120)]
    assert result(spark, rows, 1) == result(spark, rows, 7)
    df = spark.createDataFrame(rows, DOCS).withColumn("path", F.lit("mine")).withColumn("n", F.lit(9)).withColumn("a.b", F.lit(2))
    got = proofs(df.withColumn("l", leaf_of(["doc_id", "text"])), "l", "doc_id", "source")
    assert got.count() == 120 and got.columns == ["doc_id", "text", "lang", "source", "n_chars", "n", "a.b", "l", "subroot", "root", "path"]
    assert got.select(F.sum("n"), F.sum("`a.b`")).first() == (1080, 240)
    assert isinstance(got.schema["path"].dataType, T.ArrayType)
