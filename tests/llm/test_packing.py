"""Packing against a version that looks at every bin."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from unitmesh.llm.packing import Bins, pack

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_place(bins, capacity, length, source, cluster):
    """bins: list of [filled, sources, clusters] in the order they were opened."""
    fits = [(capacity - b[0], k) for k, b in enumerate(bins)
            if b[0] < capacity and length <= capacity - b[0] and not (b[1] & source or b[2] & cluster)]
    if not fits:
        bins.append([0, 0, 0])
    k = min(fits)[1] if fits else len(bins) - 1
    offset = bins[k][0]
    bins[k][0] += length
    bins[k][1] |= source
    bins[k][2] |= cluster
    return k, offset


def test_search_finds_the_tightest_compatible_bin():
    rng = random.Random(8)
    for capacity in (10, 64):
        fast, slow = Bins(capacity), []
        for _ in range(1500):
            piece = rng.randint(0, capacity), 1 << rng.choice([0, 0, 0, 1, 2, 3]), rng.choice([0, 1 << rng.randrange(50)])
            assert fast.place(*piece) == slow_place(slow, capacity, *piece)


def rows_of(df):
    return [(r["doc_id"], r["piece"], r["bin_id"], r["bin_offset"], r["n_words"]) for r in df.collect()]


def slow_pack(docs, capacity):
    """docs: (id, text, source) in one shard."""
    keyed = []
    for i, t, s in docs:
        w = WORD.findall(t or "")
        keyed.append((-len(w), i, " ".join(w), s))
    bins, out, bit = [], [], defaultdict(dict)
    mask = lambda kind, v: 1 << bit[kind].setdefault(v, len(bit[kind])) if v else 0
    for n, i, plain, s in sorted(keyed):
        for piece in range(max(1, -(n // capacity))):
            size = min(capacity, -n - piece * capacity)
            k, offset = slow_place(bins, capacity, size, mask("s", s), mask("c", plain))
            out.append((i, piece, k, offset, size))
    return sorted(out)


def test_whole_table(spark, docs_of, corpus):
    df = docs_of(corpus)
    docs = [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]
    got = sorted(rows_of(pack(df, capacity=600)))
    # pieces of equal length and different text may swap; totals per bin may not
    want = slow_pack(docs, 600)
    assert [(i, p, n) for i, p, _, _, n in got] == [(i, p, n) for i, p, _, _, n in want]
    assert got == want


def test_constraints_and_edges(spark, docs_of):
    pairs = [(1, None), (2, ""), (3, " \n"), (4, "w " * 1000), (5, "same text here"), (6, "same  text\nhere"), (None, "a b"), (None, "a b"),
             *((10 + i, f"only {i} " * (i % 40)) for i in range(300))]
    df = docs_of(pairs, piece="mine", _shard=1, _cluster="c")
    source = {(r["doc_id"]): r["source"] for r in df.collect()}
    for shard_rows in (4096, 50):
        got = rows_of(pack(df, capacity=100, shard_rows=shard_rows))
        words = defaultdict(int)
        for i, _, _, _, n in got:
            words[i] += n
        assert words[4] == 1000 and words[None] == 4 and {i for i, *_ in got} == {i for i, _ in pairs}
        bins = defaultdict(list)
        for i, p, b, o, n in got:
            bins[b].append((o, n, i))
        for held in bins.values():
            held.sort(key=lambda x: x[:2])
            assert sum(n for _, n, _ in held) <= 100
            at = 0
            for o, n, _ in held:
                assert o == at
                at += n
            sources = [source[i] for _, _, i in held if i is not None]
            assert len(sources) == len(set(sources))
            assert not {5, 6} <= {i for _, _, i in held}
    assert rows_of(pack(docs_of([]))) == []


def test_near_copies_are_apart(spark, docs_of):
    from llm.test_simhash import slow_components, slow_fingerprint

    words = [f"word{k}" for k in range(400)]
    near = " ".join([*words[:200], "other", *words[201:]])
    # copies in other letters, of one other word, exact, with a repeated and a null id
    pairs = [(1, " ".join(words)), (2, " ".join(words).upper()), (3, near), (3, " ".join(words)), (None, near), (6, ""), (7, None),
             *((20 + i, f"quite another text {i} " * (1 + i % 9)) for i in range(60))]
    df = docs_of(pairs, component_id="mine", _root=1).withColumn("source", F.lit(None).cast("string"))
    group = dict(zip(range(5), slow_components([(k, slow_fingerprint(t)) for k, (_, t) in enumerate(pairs[:5])]), strict=True))
    assert len(set(group.values())) == 1
    got = rows_of(pack(df, near=True))
    assert Counter(i for i, *_ in got) == Counter(i for i, _ in pairs)
    long = [b for i, _, b, _, n in got if n == 400]
    assert len(long) == len(set(long)) == 5
    assert len({b for i, _, b, _, n in got if n == 0}) == 1  # texts without words conflict with nothing
    # by equal texts alone they share a bin
    exact = [b for _, _, b, _, n in rows_of(pack(df)) if n == 400]
    assert len(set(exact)) < 5


def test_query_keeps_near_duplicates_apart(spark):
    from unitmesh.llm.queries import QUERIES
    from unitmesh.llm.simhash import near_duplicates

    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    part = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    got = rows_of(QUERIES["op7_packing"](spark, sf))
    held = Counter((b, part[i]) for i, _, b, _, n in got if n)
    assert max(held.values()) == 1 and len(set(part.values())) < len(part)
    words = {r["doc_id"]: len(WORD.findall(r["text"] or "")) for r in docs.collect()}
    total = Counter()
    for i, _, _, _, n in got:
        total[i] += n
    assert total == words
