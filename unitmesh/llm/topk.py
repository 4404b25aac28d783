"""Exact top-k search by distributed histogram selection.

Every query is scored against every candidate, in blocks: a bounded block of query
vectors goes to all tasks, and each task multiplies it with its Arrow batches of
candidates. Scores are not kept. Instead each pass adds up, per query, a histogram of
the scores in the range still in question (Spark sums the bins of all tasks), the bin
with the k-th highest score becomes the next range, and so on until the k-th value is
known. If more rows share that score than are needed, the same selection goes on over
their ids. A last pass filters the rows at or above each query's threshold: exactly k
rows per query, ranked by score and id.

A task sends only bins down to where it alone has k scores at or above them: the k-th
highest of all can't lie below. So what is shuffled is at most k bins a query and task,
and no query's candidates meet in one place.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from unitmesh.llm.common import col, ready, written

K = 10
EVERY = 100
SCALE = 1024
QUERY_BLOCK = 4096
BINS = 1024
ROWS_PER_BATCH = 4096
_PAIR_CELLS = 1_000_000  # scores held at once by a task


def whole_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """(``_id``, ``_v``: floor(scale * component) as longs); rows with a null id, a null
    vector or a null or non-finite component are left out."""
    v = F.transform(col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (table.where(col(id_col).isNotNull() & col(vector_col).isNotNull()).where(finite)
            .select(col(id_col).cast("long").alias("_id"), F.transform(v, lambda x: F.floor(x * scale)).alias("_v")))


def _vectors(batch: pa.RecordBatch):
    """Ids and matrices by dimension of an Arrow batch (``_id``, ``_v``)."""
    ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
    lists = batch.column(1)
    size = np.diff(lists.offsets.to_numpy(zero_copy_only=False))
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    for d in np.unique(size):
        rows = np.flatnonzero(size == d)
        cells = (ends[rows] - d)[:, None] + np.arange(d)
        yield int(d), ids[rows], flat[cells]


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer products: by floating point where every partial sum fits."""
    if queries.shape[1] == 0:
        return np.zeros((len(queries), len(rows)), np.int64)
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * queries.shape[1]
    if most < 2 ** 53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


class _Block:
    """A block of queries: their numbers, ids, and vectors by dimension."""

    def __init__(self, numbers, ids, vectors):
        self.numbers, self.ids = np.array(numbers, np.int64), np.array(ids, np.int64)
        size = np.array([len(v) for v in vectors])
        self.by_size = {int(d): (at := np.flatnonzero(size == d), np.array([vectors[i] for i in at], np.int64).reshape(len(at), d))
                        for d in np.unique(size)}

    def scored(self, batches):
        """(positions of queries, ids of candidates, scores; a query's own id is masked)."""
        for batch in batches:
            for d, ids, rows in _vectors(batch):
                if d not in self.by_size:
                    continue
                at, q = self.by_size[d]
                step = max(1, _PAIR_CELLS // max(len(at), 1))
                for lo in range(0, len(ids), step):
                    part = ids[lo:lo + step]
                    yield at, part, _products(q, rows[lo:lo + step]), self.ids[at][:, None] != part[None, :]


def _extent(block):
    """Lowest and highest score of each query, and how many there are."""
    def run(batches):
        n = len(block.value.numbers)
        low, high, count = np.full(n, np.iinfo(np.int64).max), np.full(n, np.iinfo(np.int64).min), np.zeros(n, np.int64)
        for at, _, s, other in block.value.scored(batches):
            low[at] = np.minimum(low[at], np.where(other, s, np.iinfo(np.int64).max).min(axis=1))
            high[at] = np.maximum(high[at], np.where(other, s, np.iinfo(np.int64).min).max(axis=1))
            count[at] += other.sum(axis=1)
        has = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(x[has]) for x in (block.value.numbers, low, high, count)], names=["q", "low", "high", "n"])
    return run


def _histogram(block, state, k: int):
    """Bins of the value in question: the score, or for queries whose score is known the
    id counted downwards. Bins count from the top; a task ends where it alone has k."""
    def run(batches):
        st, n = state.value, len(block.value.numbers)
        counts = np.zeros((n, BINS), np.int32)
        for at, ids, s, other in block.value.scored(batches):
            lo, hi, width = st["lo"][at][:, None], st["hi"][at][:, None], st["width"][at][:, None]
            on_ids = st["on_ids"][at][:, None]
            value = np.where(on_ids, -ids[None, :] - 1, s)
            ok = other & (value >= lo) & (value < hi) & (~on_ids | (s == st["score"][at][:, None])) & st["open"][at][:, None]
            row, c = np.nonzero(ok)
            bins = (hi[row, 0] - 1 - value[row, c]) // width[row, 0]
            np.add.at(counts, (at[row], bins), 1)
        before = np.cumsum(counts, axis=1) - counts
        row, bins = np.nonzero((counts > 0) & (before < k))
        yield pa.RecordBatch.from_arrays([pa.array(block.value.numbers[row]), pa.array(bins.astype(np.int64)),
                                          pa.array(counts[row, bins].astype(np.int64))], names=["q", "bin", "n"])
    return run


def _chosen(block, state):
    def run(batches):
        st = state.value
        for at, ids, s, other in block.value.scored(batches):
            floor, last = st["score"][at][:, None], st["last_id"][at][:, None]
            row, c = np.nonzero(other & ((s > floor) | ((s == floor) & (ids[None, :] <= last))))
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(block.value.numbers[at[row]]), pa.array(block.value.ids[at[row]]),
                                                  pa.array(ids[c]), pa.array(s[row, c])], names=["q", "query_id", "vec_id", "score"])
    return run


def _select_block(candidates: DataFrame, block: _Block, k: int, first_id: int, last_id: int) -> DataFrame:
    """(q, query_id, vec_id, score): the k best of each query of a block; the candidates'
    ids lie from ``first_id`` to ``last_id``."""
    sc = candidates.sparkSession.sparkContext
    shared = sc.broadcast(block)
    place = {int(q): i for i, q in enumerate(block.numbers)}
    n, big = len(place), np.iinfo(np.int64)
    extent = (candidates.mapInArrow(_extent(shared), "q long, low long, high long, n long")
              .groupBy("q").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))).toPandas()
    at = extent["q"].map(place).to_numpy(dtype=np.int64)
    st = {x: np.zeros(n, np.int64) for x in ("lo", "hi", "width", "need", "score", "last_id")} | {
        x: np.zeros(n, bool) for x in ("open", "on_ids")}
    st["width"][:] = 1
    st["score"][:], st["last_id"][:] = big.min, big.max  # queries with at most k candidates take them all
    many = extent["n"].to_numpy() > k
    st["open"][at[many]] = True
    st["lo"][at], st["hi"][at], st["need"][at] = extent["low"], extent["high"] + 1, k
    while st["open"].any():
        # ceil of range / bins, in Python integers where a range of ids is wide
        st["width"] = np.array([max(1, -(-(int(h) - int(lo)) // BINS)) for lo, h in zip(st["lo"], st["hi"])], np.int64)
        told = sc.broadcast(st)
        above = Window.partitionBy("q").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        need = pd.DataFrame({"q": block.numbers, "need": st["need"]})[st["open"]]
        bins = candidates.mapInArrow(_histogram(shared, told, k), "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        found = (bins.withColumn("before", F.coalesce(F.sum("n").over(above), F.lit(0)))
                 .join(F.broadcast(candidates.sparkSession.createDataFrame(need, "q long, need long")), "q")
                 .where("before < need and before + n >= need").select("q", "bin", "n", "before").toPandas())
        st = {key: v.copy() for key, v in st.items()}
        for q, b, count, before in found.itertuples(index=False):
            i = place[q]
            hi = int(st["hi"][i]) - int(b) * int(st["width"][i])
            lo = max(int(st["lo"][i]), hi - int(st["width"][i]))
            need_now = int(st["need"][i]) - int(before)
            st["lo"][i], st["hi"][i], st["need"][i] = lo, hi, need_now
            whole = count == need_now  # everything down to the bin's end is taken
            if st["on_ids"][i]:
                if whole or hi - lo == 1:
                    st["last_id"][i], st["open"][i] = -lo - 1, False
            elif whole:
                st["score"][i], st["last_id"][i], st["open"][i] = lo, big.max, False
            elif hi - lo == 1:  # the k-th score is known and too many rows have it: go on over their ids
                st["score"][i], st["on_ids"][i] = lo, True
                st["lo"][i], st["hi"][i] = -last_id - 1, -first_id
    told = sc.broadcast(st)
    return candidates.mapInArrow(_chosen(shared, told), "q long, query_id long, vec_id long, score long")


def top_k(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY,
          scale: int = SCALE, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for each row whose id is divisible
    by ``every`` the ``k`` highest integer inner products with all rows of other ids (all,
    if fewer), ties to the smaller id.

    Components become floor(scale * x). Null ids or vectors and vectors with a null or
    non-finite component take no part. Vectors of different lengths have no product and
    are not compared; empty vectors have product 0 with each other. Rows that repeat an
    id each count; a query's own id is excluded in all its rows, and of rows equal in
    score and id any may be the one cut off. An empty table gives an empty table. Extra
    columns are not read. Scores must fit in a long.
    """
    spark = table.sparkSession
    ready(spark, ROWS_PER_BATCH)
    vectors = written(whole_vectors(table, id_col, vector_col, scale), "topk-vectors")
    queries = written(vectors.where(F.col("_id") % every == 0).withColumn("_q", F.monotonically_increasing_id()), "topk-queries")
    # Dealt by a hash to blocks of about ``query_block`` queries, however the rows lie.
    blocks = -(-queries.count() // query_block)
    own = F.pmod(F.xxhash64("_q"), F.lit(blocks))
    first_id, last_id = vectors.agg(F.min("_id"), F.max("_id")).first()
    out = None
    for b in range(blocks):
        rows = queries.where(own == b).toArrow()
        if not rows.num_rows:
            continue
        block = _Block(rows.column("_q").to_pylist(), rows.column("_id").to_pylist(), rows.column("_v").to_pylist())
        part = written(_select_block(vectors, block, k, first_id, last_id), "topk-part")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
