"""SimHash near-duplicate groups with pivot distance tables.

1. Every document gets a 64-bit SimHash of its word shingles (XXH64, seed 42).
2. Equal fingerprints collapse to one row (partial aggregation: a copy group that
   holds a third of all rows is one row per task before the shuffle).
3. For every distinct fingerprint a table of Hamming distances to many reference
   fingerprints (pivots) is computed. The references are a base fingerprint and, for
   each of five bands of bits, variants of the base that differ from it in fixed
   subsets of that band. The distance to a variant minus the distance to the base
   depends on the band's bits only, so the coordinates of a band are equal for
   fingerprints that agree on the band. Two fingerprints at most three bits apart
   agree on at least two of five bands, so all their coordinates of some two bands are
   equal: candidates come from an equi-join of the distance tables on two bands'
   coordinates (ten band pairs), never from comparing everything with everything.
4. Inside a join group a pair is discarded if any coordinate differs by more than the
   bit distance (the triangle inequality), and survivors are verified exactly.
5. Groups above a tile size are dealt as pairs of tiles to many tasks, and each task
   returns only a spanning forest of the links it verified, so neither a hot group nor
   its number of pairs ever meets in one task. No candidate is capped.
6. Connected components over the distinct fingerprints (``components.py``).
"""

from __future__ import annotations

from hashlib import md5
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from unitmesh.llm.common import col, ready, written
from unitmesh.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
TILE_ROWS = 2048
_BASE = 0x9E3779B97F4A7C15
_PER_BAND = 12


# ------------------------------------------------------------------ fingerprints
def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text (unsigned)."""
    import xxhash

    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingle = len(words)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    stops = (ends[shingle - 1:] - 1).tolist()
    starts = [0, *ends[:len(stops) - 1].tolist()]
    digest, n = xxhash.xxh64_digest, len(stops)
    counts = np.zeros(64, np.int64)
    for lo in range(0, n, 1 << 16):
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[lo:lo + (1 << 16)], stops[lo:lo + (1 << 16)])])
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def _fingerprint_batches(shingle: int, names: list[str]):
    def run(batches):
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            out = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            sums = pa.array([md5(t, usedforsecurity=False).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out), sums], names=names)
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(``_id``, ``_fp``, ``_md5``): the signed 64-bit SimHash and the MD5 of each row's whole text."""
    ready(docs.sparkSession)
    out = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_fp", T.LongType()),
                        T.StructField("_md5", T.BinaryType())])
    return docs.select(col(id_col).alias("_id"), col(text_col).alias("_text")).mapInArrow(
        _fingerprint_batches(shingle, out.names), out)


# ------------------------------------------------------------------ pivot tables
class Pivots:
    """Reference fingerprints for a bit distance, and the distance tables to them."""

    def __init__(self, max_bits: int = MAX_BITS):
        self.max_bits = max_bits
        self.bands = max_bits + 2  # any two within max_bits agree on at least two bands
        edges = [round(64 * b / self.bands) for b in range(self.bands + 1)]
        rng = np.random.default_rng(7)
        refs = [_BASE]
        for lo, hi in zip(edges, edges[1:]):
            # Subsets of the band: single halves by binary digit of the bit's place,
            # then seeded random subsets; together they nearly tell the band's bits.
            places = np.arange(hi - lo)
            subsets = [(places >> d) & 1 for d in range(4)]
            subsets += [rng.integers(0, 2, hi - lo) for _ in range(_PER_BAND - len(subsets))]
            for s in subsets:
                refs.append(_BASE ^ sum(1 << int(lo + p) for p in places[s == 1]))
        self.refs = np.array(refs, np.uint64)
        self.pairs = list(combinations(range(self.bands), 2))

    def table(self, fps: np.ndarray) -> np.ndarray:
        """Hamming distances (rows: fingerprints, columns: references)."""
        out = np.empty((len(fps), len(self.refs)), np.int16)
        for k, r in enumerate(self.refs):
            out[:, k] = np.bitwise_count(fps ^ r)
        return out

    def keys(self, fps: np.ndarray) -> np.ndarray:
        """One join key for each band pair: the two bands' coordinates relative to the
        base reference, packed (each within -15..16)."""
        t = self.table(fps)
        rel = (t[:, 1:] - t[:, :1] + 15).astype(np.uint64).reshape(len(fps), self.bands, _PER_BAND)
        band = np.zeros((len(fps), self.bands), np.uint64)
        for j in range(_PER_BAND):
            band = band * np.uint64(31) + rel[:, :, j]
        mix = np.uint64(0x9E3779B97F4A7C15)
        out = np.empty((len(fps), len(self.pairs)), np.uint64)
        for k, (a, b) in enumerate(self.pairs):
            out[:, k] = (band[:, a] * mix) ^ (band[:, b] + np.uint64(k))
            out[:, k] = out[:, k] * mix
        return out.view(np.int64)


def _key_batches(max_bits: int):
    def run(batches):
        pivots = Pivots(max_bits)
        n = len(pivots.pairs)
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            keys = pivots.keys(fps.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(n, dtype=np.int32), len(fps))), pa.array(keys.reshape(-1)),
                 pa.array(np.repeat(fps, n))], names=["_pair", "_key", "_fp"])
    return run


def forest(groups: np.ndarray, fps: np.ndarray, pivots: Pivots) -> list[tuple[int, int]]:
    """Links (positions) of a spanning forest of the verified pairs within each group.
    Rows lie sorted by group; pairs are compared lag by lag, all groups at once."""
    parent = np.arange(len(fps))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    links: list[tuple[int, int]] = []
    table = pivots.table(fps)
    at, lag = np.arange(len(fps)), 0
    while True:
        lag += 1
        at = at[at + lag < len(fps)]
        at = at[groups[at] == groups[at + lag]]
        if not len(at):
            return links
        near = at
        for k in range(table.shape[1]):  # pivot coordinates, until none is left to tell apart
            near = near[np.abs(table[near, k] - table[near + lag, k]) <= pivots.max_bits]
            if not len(near):
                break
        near = near[np.bitwise_count(fps[near] ^ fps[near + lag]) <= pivots.max_bits]
        near = near[parent[near] != parent[near + lag]]
        for i in near.tolist():
            a, b = root(i), root(i + lag)
            if a != b:
                parent[max(a, b)] = min(a, b)
                links.append((i, i + lag))
        if len(near):
            while True:
                up = parent[parent]
                if np.array_equal(up, parent):
                    break
                parent = up


def _forest_batches(max_bits: int):
    """Rows come sorted by group; a group may run over several batches."""
    def run(batches):
        pivots = Pivots(max_bits)

        def links(groups, fps):
            found = forest(groups, fps.view(np.uint64), pivots)
            a, b = (np.array([x[k] for x in found], np.int64) for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(fps[a]), pa.array(fps[b])], names=["_a", "_b"])

        held_g, held_f = np.zeros((0, 4), np.int64), np.zeros(0, np.int64)
        for batch in batches:
            cols = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)]
            g = np.concatenate([held_g, np.stack(cols[:4], axis=1)])
            f = np.concatenate([held_f, cols[4]])
            if not len(f):
                continue
            new = np.concatenate([[0], (g[1:] != g[:-1]).any(axis=1).cumsum()])
            cut = int(np.searchsorted(new, new[-1]))
            if cut:
                yield links(new[:cut], f[:cut])
            held_g, held_f = g[cut:], f[cut:]
        if len(held_f):
            yield links(np.zeros(len(held_f), np.int64), held_f)
    return run


def near_links(fps: DataFrame, max_bits: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Links (``_a``, ``_b``) between distinct fingerprints (column ``_fp``), enough to
    connect all that are connected by steps of at most ``max_bits`` bits."""
    keyed = fps.select("_fp").mapInArrow(_key_batches(max_bits), "_pair int, _key long, _fp long")
    sizes = written(keyed.groupBy("_pair", "_key").count().where("count > 1"), "simhash-groups")
    grouped = keyed.join(sizes, ["_pair", "_key"]).withColumn(
        "_tiles", F.ceil(F.col("count") / F.lit(tile_rows)).cast("int"))
    own = F.pmod(F.xxhash64("_fp", "_pair"), F.col("_tiles")).cast("int")
    tiled = grouped.withColumn("_own", own).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    dealt = tiled.select("_pair", "_key", F.least("_own", "_other").alias("_i"),
                         F.greatest("_own", "_other").alias("_j"), "_fp")
    return (dealt.repartition("_pair", "_key", "_i", "_j").sortWithinPartitions("_pair", "_key", "_i", "_j", "_fp")
            .mapInArrow(_forest_batches(max_bits), "_a long, _b long"))


def grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int, tile_rows: int) -> DataFrame:
    """(``_id``, ``_fp``, ``_md5``, ``_cid``, ``_root``) of every row: fingerprint, the
    text's MD5, the component's smallest id and its name among fingerprints."""
    ready(docs.sparkSession)
    rows = written(fingerprints(docs, id_col, text_col, shingle), "simhash-rows")
    nodes = written(rows.groupBy("_fp").agg(F.min("_id").alias("_rep")), "simhash-nodes")
    roots = connected_components(near_links(nodes, max_bits, tile_rows), "_a", "_b")
    placed = written(nodes.join(roots, nodes["_fp"] == roots["node"], "left").select("_fp", "_rep", "root"),
                     "simhash-placed")
    linked = placed.where(F.col("root").isNotNull())
    least = written(linked.groupBy("root").agg(F.min("_rep").alias("_cid")), "simhash-least")
    of_fp = written(
        linked.join(least, "root").select("_fp", "_cid", F.col("root").alias("_root"))
        .unionAll(placed.where(F.col("root").isNull()).select("_fp", F.col("_rep").alias("_cid"), F.col("_fp").alias("_root"))),
        "simhash-of-fp")
    return rows.join(of_fp, "_fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """(id, ``fingerprint``, ``component_id``) for every row of ``docs``.

    Fingerprints of at most ``max_bits`` differing bits are linked; the component id is
    the smallest id reachable. Texts without a word (null, empty, white space) have
    fingerprint zero and are linked like any other. Rows that repeat an id or a text
    each get their row; null ids never become a component's id unless all its ids are
    null. An empty table gives an empty table. Extra columns are not read.
    """
    return grouped(docs, id_col, text_col, shingle, max_bits, tile_rows).select(
        F.col("_id").alias(id_col), F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"),
        F.col("_cid").alias("component_id"))


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                     max_bits: int = MAX_BITS, tile_rows: int = TILE_ROWS) -> DataFrame:
    """One row of each component of :func:`near_duplicates`, unchanged: the one with the
    smallest id (a null id only if there is no other; ties: the smallest MD5 of the text;
    of rows equal in both any one)."""
    rows = grouped(docs, id_col, text_col, shingle, max_bits, tile_rows)
    first = F.min(F.struct(F.col("_id").isNull().alias("null"), F.col("_id").alias("id"), F.col("_md5").alias("md5"),
                           F.col("_n").alias("n")))
    best = written(rows.groupBy("_root", "_id", "_md5").agg(F.count(F.lit(1)).alias("_n"))
                   .groupBy("_root").agg(first.alias("b")).select(F.col("b.id").alias("_kid"), F.col("b.md5").alias("_kmd5"), F.col("b.n").alias("_kn")),
                   "simhash-kept")
    text = F.unhex(F.md5(F.coalesce(col(text_col), F.lit("")).cast("binary")))
    kept = docs.join(best, col(id_col).eqNullSafe(F.col("_kid")) & (text == F.col("_kmd5")), "left_semi")
    if best.where("_kn > 1").isEmpty():
        return kept
    # Rows equal in id and text: one of them (a null and an empty text have the same MD5).
    marked = kept.select(F.struct(*[col(c) for c in docs.columns]).alias("_doc"), col(id_col).alias("_k1"), text.alias("_k2"))
    return marked.groupBy("_k1", "_k2").agg(F.first("_doc").alias("_doc")).select("_doc.*")
