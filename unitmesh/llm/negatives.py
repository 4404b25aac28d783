"""Hard-negative mining with rotated one-bit codes.

The index holds, for every row, its integer vector, the sign bits of the vector turned by a
fixed random rotation (one bit a component, in 64-bit words), the vector's length and the
alignment with its code: the unit vector that the signs, turned back, point along. A vector
is its part along the code plus a residual orthogonal to it, so for an anchor q

    <row, q> = length * alignment * <code, q> + <residual, q>,
    |<residual, q>| <= length * sqrt(1 - alignment^2) * sqrt(|q|^2 - <code, q>^2)

(Cauchy-Schwarz, as only q's part orthogonal to the code meets the residual). Vectors are
rotated in a wider space, zeros added (``signs_of``): the more signs, the
nearer a vector is to its code (alignment 0.80 with as many signs as components, 0.97 with
eight times as many), and the narrower the interval. <code, q> is estimated by popcounts:
the turned anchor is rounded to an integer of a few bits a component, and each bit plane
takes an AND and a popcount with the signs; what the rounding left adds its own length as a
further bound. All bounds are deterministic. Rows whose interval can't reach the anchor's
result are skipped, the others are scored with integers.

Two passes over the index, for as many anchors at a time as a byte bound lets one scan
broadcast: the first finds each anchor's best rows of its own label, the second the best
rows of other labels in the score band of each of these. A task keeps only its own best
rows of an anchor (or anchor and positive), which raises the threshold that intervals must
reach; Spark merges the tasks' few rows.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from unitmesh.llm.common import col, ready, written

SCALE, EVERY, LABELS = 256, 100, 10
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # a negative's score in hundredths of the positive's
RENAMED_EVERY = 7
SEED = 20240630
WIDEN, MOST_SIGNS, PLANES = 8, 1024, 6
ROWS_PER_BATCH = 4096
BLOCK_BYTES = 64 * 1024 * 1024  # of anchors broadcast for one scan
_PAIRS = 1 << 18  # pairs of rows and anchors held at once by a task


def labelled_vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE,
                     renamed_every: int = RENAMED_EVERY, labels: int = LABELS) -> DataFrame:
    """(``_id``, ``_label``, ``_v``: floor(scale * component) as longs). Rows with a null id,
    label or vector or a null or non-finite component are left out; the label of every
    ``renamed_every``-th id moves on by one."""
    v = F.transform(col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    i, label = col(id_col).cast("long"), col(label_col).cast("long")
    return (table.where(col(id_col).isNotNull() & col(vector_col).isNotNull() & col(label_col).isNotNull()).where(finite)
            .select(i.alias("_id"), F.when(i % renamed_every == 0, (label + 1) % labels).otherwise(label).alias("_label"),
                    F.transform(v, lambda x: F.floor(x * scale)).alias("_v")))


def signs_of(d: int) -> int:
    """Signs in the code of a vector of ``d`` dimensions."""
    return max(d, min(WIDEN * d, MOST_SIGNS))


@cache
def rotation(d: int) -> np.ndarray:
    """``d`` columns of the fixed random rotation of ``signs_of(d)`` dimensions: what it does
    to vectors whose other components are zero."""
    q, r = np.linalg.qr(np.random.default_rng(SEED + d).standard_normal((signs_of(d), signs_of(d))))
    return (q * np.sign(np.diag(r)))[:, :d]


def _matrices(lists: pa.Array):
    """(dimension, positions, matrix) of a column of vectors."""
    size = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield int(d), at, flat[(ends[at] - d)[:, None] + np.arange(d)]


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    n, d = bits.shape
    wide = np.zeros((n, -(-d // 64) * 64), bool)
    wide[:, :d] = bits
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def encode(vectors: np.ndarray):
    """(signs as words, lengths, alignments, lengths of the signs turned back) of a matrix
    of vectors. A zero vector has length and alignment 0."""
    frame = rotation(vectors.shape[1])
    turned = vectors.astype(float) @ frame.T > 0
    back = np.where(turned, 1.0, -1.0) @ frame
    length, code = np.sqrt((vectors.astype(float) ** 2).sum(axis=1)), np.sqrt((back * back).sum(axis=1))
    both = length * code
    return _words(turned), length, np.divide((back * vectors).sum(axis=1), both, out=np.zeros_like(both), where=both > 0), code


def _index(batches):
    for batch in batches:
        n = batch.num_rows
        signs, length, aligned, code = [b""] * n, np.zeros(n), np.zeros(n), np.ones(n)
        for d, at, vectors in _matrices(batch.column(2)):
            if d:
                words, length[at], aligned[at], code[at] = encode(vectors)
                for i, w in zip(at, words):
                    signs[i] = w.tobytes()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.binary()), pa.array(length), pa.array(aligned), pa.array(code)],
                                         names=["_id", "_label", "_v", "_signs", "_length", "_aligned", "_code"])


class Anchors:
    """Anchors of one dimension: vectors and the bit planes of their rounded, turned form."""

    def __init__(self, numbers, ids, labels, vectors):
        self.numbers, self.ids, self.labels, self.vectors = numbers, ids, labels, vectors
        turned = vectors.astype(float) @ rotation(vectors.shape[1]).T
        self.square = (turned * turned).sum(axis=1)
        self.low = turned.min(axis=1, initial=0.0)
        top = (1 << PLANES) - 1
        self.step = np.maximum(turned.max(axis=1, initial=0.0) - self.low, 1e-300) / top
        rounded = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.int64)
        off = turned - (self.low[:, None] + rounded * self.step[:, None])
        self.off = np.sqrt((off * off).sum(axis=1))
        self.total = rounded.sum(axis=1)
        self.planes = [_words((rounded >> b) & 1 == 1) for b in range(PLANES)]

    def part(self, s) -> Anchors:
        out = object.__new__(Anchors)
        for name, value in vars(self).items():
            setattr(out, name, [p[s] for p in value] if name == "planes" else value[s])
        return out

    def intervals(self, words, length, aligned, code):
        """Lowest and highest score (anchors x rows) that signs and alignments allow."""
        wide = signs_of(self.vectors.shape[1])
        ones = np.bitwise_count(words).sum(axis=1, dtype=np.int64).astype(float)
        inside = np.zeros((len(self.ids), len(words)))  # sum of rounded components where the sign is plus
        for b, plane in enumerate(self.planes):
            count = np.zeros(inside.shape, np.uint32)
            for w in range(words.shape[1]):
                count += np.bitwise_count(plane[:, w][:, None] & words[:, w][None, :])
            inside += count * float(1 << b)
        # sum over +-1: twice the sum at the pluses less the sum of all
        signed = self.step[:, None] * (2 * inside - self.total[:, None]) + self.low[:, None] * (2 * ones - wide)[None, :]
        per = 1 / np.maximum(code, 1e-300)
        along, off = signed * per[None, :], self.off[:, None] * (np.sqrt(wide) * per)[None, :]
        near = np.maximum(np.abs(along) - off, 0.0)
        beside = np.sqrt(np.maximum(self.square[:, None] - near * near, 0.0))
        middle = along * (length * aligned)[None, :]
        slack = off * np.abs(length * aligned)[None, :] + beside * (length * np.sqrt(np.maximum(1 - aligned * aligned, 0.0)))[None, :]
        slack += 1e-9 * np.sqrt(self.square)[:, None] * length[None, :] + 1e-6  # what floating point may lose
        return middle - slack, middle + slack


class Block:
    """Anchors by dimension, numbered from 0 in the block."""

    def __init__(self, numbers, ids, labels, vectors):
        size = np.array([len(v) for v in vectors])
        self.by_size = {int(d): Anchors(np.array(numbers)[at := np.flatnonzero(size == d)], np.array(ids, np.int64)[at], np.array(labels, np.int64)[at],
                                        np.array([vectors[i] for i in at], np.int64).reshape(len(at), d)) for d in np.unique(size)}
        self.ids, self.n = np.array(ids, np.int64), len(ids)

    def met(self, batches, same_label: bool):
        """(part of the anchors, ids, labels, vectors, lowest, highest) for every batch of
        the index and bounded part of the block; rows of the anchors' own label only, or all."""
        for batch in batches:
            ids, labels = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
            length, aligned, code = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5, 6))
            for d, at, vectors in _matrices(batch.column(2)):
                if d not in self.by_size:
                    continue
                every = self.by_size[d]
                words = np.frombuffer(b"".join(batch.column(3).take(pa.array(at)).to_pylist()), np.uint64).reshape(len(at), -(-signs_of(d) // 64))
                meet = [(every.labels == x, labels[at] == x) for x in np.intersect1d(every.labels, labels[at])] if same_label else [(slice(None), slice(None))]
                for of, rows in meet:
                    own, to, r = every.part(of), at[rows], (words[rows], length[at][rows], aligned[at][rows], code[at][rows])
                    step = max(1, _PAIRS // len(to))
                    for lo in range(0, len(own.ids), step):
                        a = own.part(slice(lo, lo + step))
                        low, high = a.intervals(*r) if d else (np.zeros((len(a.ids), len(to))),) * 2
                        yield a, ids[to], labels[to], vectors[rows], low, high


def _scores(a: Anchors, vectors: np.ndarray, i: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Integer products of anchor ``i`` and row ``r``: one by one, or all at once where many
    are wanted and every partial sum is an integer that a double holds."""
    most = float(np.abs(a.vectors).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * vectors.shape[1]
    if len(i) * 16 > len(a.ids) * len(vectors) and most < 2 ** 53:
        return (a.vectors.astype(float) @ vectors.T.astype(float))[i, r].astype(np.int64)
    out = np.empty(len(i), np.int64)
    for lo in range(0, len(i), 65536):
        s = slice(lo, lo + 65536)
        out[s] = np.einsum("ij,ij->i", a.vectors[i[s]], vectors[r[s]])
    return out


class Best:
    """The ``k`` best (score, smaller id) rows of each place so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.place, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.floor = np.full(n, np.iinfo(np.int64).min)  # a place's k-th score, once it has k

    def add(self, place, score, ids):
        if not len(place):
            return
        place, score, ids = (np.concatenate(x) for x in ((self.place, place), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, place))
        place, score, ids = place[order], score[order], ids[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        keep = rank < self.k
        self.place, self.score, self.id, rank = place[keep], score[keep], ids[keep], rank[keep]
        full = rank == self.k - 1
        self.floor[self.place[full]] = self.score[full]


def _positives(shared, k: int):
    def run(batches):
        block = shared.value
        best = Best(block.n, k)
        for a, ids, _, vectors, _, high in block.met(batches, True):
            ok = (a.ids[:, None] != ids[None, :]) & (high >= best.floor[a.numbers][:, None])
            i, r = np.nonzero(ok)
            best.add(a.numbers[i], _scores(a, vectors, i, r), ids[r])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.place, best.score, best.id, block.ids[best.place])],
                                         names=["q", "score", "id", "anchor_id"])
    return run


def _negatives(shared, bands, k: int):
    """``bands``: lowest and highest score for each anchor number and positive; the place of
    a band is anchor number * positives + rank of the positive from 0."""
    def run(batches):
        block, (least, most) = shared.value, bands.value
        width = least.shape[1]
        best = Best(least.size, k)
        for a, ids, labels, vectors, low, high in block.met(batches, False):
            other = a.labels[:, None] != labels[None, :]
            reach = np.zeros(other.shape, bool)
            spans = []
            for j in range(width):
                p = a.numbers * width + j
                lo, hi = np.maximum(least[a.numbers, j], best.floor[p]), most[a.numbers, j]  # a full place asks for its k-th score at least
                reach |= (high >= lo[:, None]) & (low <= hi[:, None]) & (lo <= hi)[:, None]
                spans.append((p, lo, hi))
            i, r = np.nonzero(other & reach)
            score = _scores(a, vectors, i, r)
            for p, lo, hi in spans:
                fits = (score >= lo[i]) & (score <= hi[i])
                best.add(p[i[fits]], score[fits], ids[r[fits]])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (best.place, best.score, best.id)], names=["q", "score", "id"])
    return run


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each ``q`` with ``rank`` from 1."""
    return (found.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id")))
            .where(F.col("rank") <= k))


def _block_negatives(index: DataFrame, block: Block, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of a block."""
    spark = index.sparkSession
    shared = spark.sparkContext.broadcast(block)
    best = written(_merged(index.mapInArrow(_positives(shared, positives), "q long, score long, id long, anchor_id long"), positives), "negatives-positives")
    # At most ``positives`` rows for each anchor of the block come to the driver.
    known = best.select("q", "rank", "score").toArrow()
    q, rank, p = (known.column(c).to_numpy().astype(np.int64) for c in ("q", "rank", "score"))
    least, most = np.ones((block.n, positives), np.int64), np.zeros((block.n, positives), np.int64)  # no positive: an empty band
    least[q, rank - 1], most[q, rank - 1] = -((-low * p) // 100), (high * p) // 100
    bands = spark.sparkContext.broadcast((least, most))
    found = _merged(index.mapInArrow(_negatives(shared, bands, negatives), "q long, score long, id long"), negatives)
    pairs = best.select((F.col("q") * positives + F.col("rank") - 1).alias("q"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(pairs, "q").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                                         "positive_score", F.col("score").alias("negative_score"))


def hard_negatives(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = EVERY,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
                   renamed_every: int = RENAMED_EVERY, labels: int = LABELS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``): for every row whose id is divisible by ``every`` and each of its
    best ``positives`` other rows of its label, the best ``negatives`` rows of other labels
    whose score lies from ``low`` to ``high`` hundredths of the positive's (all, if fewer;
    ties to the smaller id). A positive score below zero has no such scores.

    Which rows take no part: see :func:`labelled_vectors`. Vectors of different lengths have
    no product and do not meet; empty vectors have product 0. Rows that repeat an id each
    count, but an id is never its own positive; of rows equal in score and id any may be
    the one cut off. An empty table gives an empty table; extra columns are not read. Sums
    of products must fit in a long. The result is exact: intervals only skip rows.
    """
    spark = table.sparkSession
    ready(spark, ROWS_PER_BATCH)
    rows = labelled_vectors(table, id_col, vector_col, label_col, scale, renamed_every, labels)
    index = written(rows.mapInArrow(_index, "_id long, _label long, _v array<long>, _signs binary, _length double, _aligned double, _code double"), "negatives-index")
    anchors = written(index.where(F.col("_id") % every == 0).select("_id", "_label", "_v").withColumn("_q", F.monotonically_increasing_id()), "negatives-anchors")
    n, cells = anchors.agg(F.count(F.lit(1)), F.sum(F.size("_v").cast("long"))).first()
    # A component takes 8 bytes, its bit planes six bits for each sign.
    blocks = max(1, -(-(16 * (cells or 0) + 100 * n) // block_bytes)) if n else 0
    out = None
    for b in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("_q"), F.lit(blocks)) == b).toArrow()
        if part.num_rows:
            block = Block(range(part.num_rows), *[part.column(c).to_pylist() for c in ("_id", "_label", "_v")])
            found = written(_block_negatives(index, block, positives, negatives, low, high), "negatives-part")
            out = found if out is None else out.unionAll(found)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out
