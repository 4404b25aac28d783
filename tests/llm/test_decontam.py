"""Decontamination against sliding every window over every document."""

from __future__ import annotations

import re

from unitmesh.llm.decontam import contamination, drop_contaminated

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def slow(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        if w and i is not None:
            n = min(window, len(w))
            for k in range(len(w) - n + 1):
                wins.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k:k + n])) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[x]
        out.append((i, len(w), len(hit), sorted(map(str, found)), bool(hit)))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "item_ids", "contaminated").collect()), key=str)


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id string, text string, doc_id string")


def test_whole_tables(spark, docs_of, corpus):
    items = [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    got = result(contamination(docs_of(corpus), items_of(spark, items)))
    assert got == slow(corpus, items) and any(r[4] for r in got)


def test_edges(spark, docs_of, monkeypatch):
    from unitmesh.llm import decontam

    long = " ".join(f"w{i}" for i in range(14))
    items = [("a", long), ("b", "only four words here"), ("c", "One"), ("d", None), ("e", "..."), (None, "two words"),
             ("f", "x x x x x x x x x x x x"), ("b", "another small one"), ("g", "É été über naïve ça là où dès maïs noël")]
    docs = [(1, None), (2, ""), (3, "Only, FOUR words -- here!"), (4, "zero one two"), (5, f"pre {long} post {long}"),
            (6, "x " * 30), (7, " ".join(long.split()[:9])), (8, " ".join(long.split()[2:12])), (None, "only four words here"),
            (3, "another small one"), (9, "É été über naïve ça là où dès maïs noël"), (10, "é été über naïve ça là où dès maïs noël"),
            (11, "filler " * 50000 + long), (12, "four words here only")]
    want = slow(docs, items)
    df = docs_of(docs, n_words="mine", _w=3, item_id="q")
    assert result(contamination(df, items_of(spark, items))) == want
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", 0)  # the same joins, shuffled
    assert result(contamination(df, items_of(spark, items))) == want
    kept = drop_contaminated(df, items_of(spark, items))
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((r[0] for r in want if not r[4]), key=str)
    assert result(contamination(docs_of([]), items_of(spark, items))) == []
    assert not any(r[4] for r in result(contamination(df, items_of(spark, []))))


def test_no_words_of_a_document_are_shuffled(spark, monkeypatch):
    from unitmesh.llm import decontam

    monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    rows = spark.createDataFrame([(1, 30, [f"w{i}" for i in range(30)])], "_rid long, _n int, _w array<string>")
    shingles = spark.createDataFrame([(5, 1, "a b c d e")], "_size int, _h long, _s string")
    plan = decontam._hits(rows, shingles, [5])._jdf.queryExecution().executedPlan()
    moved = []

    def walk(node):
        if "Exchange" in node.nodeName():
            moved.append(node.output().mkString(","))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan.initialPlan() if "Adaptive" in plan.nodeName() else plan)
    assert moved and all("_w#" not in columns for columns in moved)
