"""SimHash groups against a brute-force comparison of all fingerprints."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from unitmesh.llm.components import connected_components
from unitmesh.llm.simhash import Pivots, fingerprint, near_duplicates, near_links


def slow_fingerprint(text):
    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, max_bits=3):
    """nodes: list of (id, fingerprint); the smallest id reachable of each position."""
    group = list(range(len(nodes)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x
    for i in range(len(nodes)):
        for j in range(i):
            if (nodes[i][1] ^ nodes[j][1]).bit_count() <= max_bits and root(i) != root(j):
                group[root(i)] = root(j)
    least = {}
    for i, (k, _) in enumerate(nodes):
        r = root(i)
        least[r] = k if least.get(r) is None else (least[r] if k is None else min(least[r], k))
    return [least[root(i)] for i in range(len(nodes))]


def result(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=str)


def expected(pairs):
    nodes = [(i, slow_fingerprint(t)) for i, t in pairs]
    return sorted(((i, f"{f:016x}", c) for (i, f), c in zip(nodes, slow_components(nodes), strict=True)), key=str)


def near_copies(rng, n):
    base = [f"w{rng.randrange(400)}" for _ in range(900)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
        out.append((1000 + i, " ".join(words)))
    return out


def test_whole_table_against_brute_force(docs_of, corpus):
    pairs = corpus + near_copies(random.Random(3), 60)
    assert result(near_duplicates(docs_of(pairs))) == expected(pairs)


def test_hot_group_in_tiles_equals_untiled(docs_of):
    pairs = near_copies(random.Random(5), 120)
    assert result(near_duplicates(docs_of(pairs), tile_rows=16)) == expected(pairs)


def test_nulls_empty_repeated_clashing_and_long(docs_of):
    pairs = [(1, None), (2, ""), (3, " \n\t"), (None, "one two three four"), (5, "One two three four"),
             (5, "one two three four"), (6, "ÉCOLE école"), (7, "a"), (8, "a b"), (9, "x y z " * 60000), (None, None)]
    df = docs_of(pairs, fingerprint="other", component_id=0, _fp=1)
    assert result(near_duplicates(df)) == expected(pairs)
    assert result(near_duplicates(docs_of([]))) == []
    assert result(near_duplicates(docs_of([(None, "a b c"), (None, "a b c")]))) == [(None, f"{slow_fingerprint('a b c'):016x}", None)] * 2


def test_pivot_keys_meet_and_bound_holds():
    rng, pivots = np.random.default_rng(2), Pivots()
    a = rng.integers(0, 2**63, 500, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.integers(0, 64, rng.integers(0, 4)):
            b[i] ^= np.uint64(1 << int(bit))
    assert (pivots.keys(a) == pivots.keys(b)).any(axis=1).all()
    assert (np.abs(pivots.table(a) - pivots.table(b)).max(axis=1) <= 3).all()


def test_links_do_not_list_all_pairs(spark):
    """A group of n fingerprints yields at most n - 1 links per band pair."""
    fps = [(i,) for i in range(256)]  # eight free bits
    links = near_links(spark.createDataFrame(fps, "_fp long"))
    assert links.count() <= 10 * 255
    assert fingerprint(b"") == 0


@pytest.mark.parametrize("n", [0, 1, 40])
def test_components_of_chains_and_hubs(spark, n):
    links = [(i, i + 1) for i in range(n)] + [(500, 500 + i) for i in range(n)] + [(7000, None), (8000, 8000)]
    got = {r["node"]: r["root"] for r in connected_components(
        spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(n + 1)} | {500 + i: 500 for i in range(n)} if n > 1 else ({0: 0, 1: 0} if n else {})
    assert got == want
