"""Best-fit packing of documents into sequences, under conflict constraints.

A document is cut into pieces of at most ``capacity`` words; a piece that fills a
sequence has it for itself, the last piece competes for the room that is left. Bins are
ordered by what is left in them and carry two bitmaps: the sources and the duplicate
clusters they already hold. A piece goes to the bin with the least room that still
fits it; if that bin conflicts (same source, or same cluster), the search goes on to
the successor until the tightest compatible bin is found, else a new bin opens.

Best fit decreasing needs an order, so rows are dealt by a hash of their number to shards of about
``shard_rows`` rows, and each shard is one streamed, sorted run of (length, source,
cluster) without texts. The number of shards grows with the table, a hot source or
cluster is spread over all shards, and a task holds one shard's open bins at a time.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from unitmesh.llm.common import col, ready, written
from unitmesh.llm.simhash import MAX_BITS, SHINGLE, TILE_ROWS, grouped

CAPACITY = 2048
SHARD_ROWS = 4096
_WORD = r"[^\x20\x09-\x0D]+"


class Bins:
    """The open bins of one shard."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[tuple[int, int]] = []  # (room left, bin), ascending
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.filled: list[int] = []

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """The bin and offset for a piece; ``source`` and ``cluster`` are bitmaps (0: none)."""
        at = bisect_left(self.order, (length, -1))
        while at < len(self.order):
            room, k = self.order[at]
            if not (self.sources[k] & source or self.clusters[k] & cluster):
                del self.order[at]
                break
            at += 1
        else:
            room, k = self.capacity, len(self.filled)
            self.sources.append(0)
            self.clusters.append(0)
            self.filled.append(0)
        self.sources[k] |= source
        self.clusters[k] |= cluster
        offset = self.filled[k]
        self.filled[k] += length
        if room > length:
            insort(self.order, (room - length, k))
        return k, offset


class _Shard:
    def __init__(self, number: int, capacity: int):
        self.number, self.bins = number, Bins(capacity)
        self.bit: dict = {}

    def mask(self, kind: str, value) -> int:
        """One bit for each value of a kind, numbered as they come; none for null."""
        if value is None:
            return 0
        bits = self.bit.setdefault(kind, {})
        return 1 << bits.setdefault(value, len(bits))


def _pack_batches(capacity: int, names: list[str]):
    """Rows (shard, order key, length, source, cluster, row) come sorted within a shard."""
    def run(batches):
        shard = None
        for batch in batches:
            at = {n: batch.column(k).to_pylist() for k, n in enumerate(batch.schema.names)}
            out: dict[str, list] = {n: [] for n in ("_at", "_piece", "_bin", "_offset", "_n")}
            for i, number in enumerate(at["_shard"]):
                if shard is None or shard.number != number:
                    shard = _Shard(number, capacity)
                total = at["_words"][i]
                source, cluster = shard.mask("source", at["_source"][i]), shard.mask("cluster", at["_cluster"][i])
                for piece in range(max(1, -(-total // capacity))):
                    n = min(capacity, total - piece * capacity)
                    k, offset = shard.bins.place(n, source, cluster)
                    for name, v in zip(out, (i, piece, (number << 32) + k, offset, n), strict=True):
                        out[name].append(v)
            ids = batch.column(batch.schema.names.index("_id")).take(pa.array(out["_at"], pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(out[n], pa.int64()) for n in names[1:])], names=names)
    return run


def measured(docs: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    """(``_id``, ``_rid``, ``_words``, ``_source``, ``_cluster``): a row number, words of the whole text, and the
    hash of its words (texts equal but for white space are one duplicate cluster; texts
    without words are in none); then ``more``."""
    text = F.coalesce(col(text_col), F.lit(""))
    words = F.regexp_count(text, F.lit(_WORD)).cast("long")
    plain = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    return docs.select(col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_rid"), words.alias("_words"),
                       col(source_col).cast("string").alias("_source"),
                       F.when(plain != "", F.md5(plain.cast("binary"))).alias("_cluster"), *more)


def near_measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The rows of :func:`measured` with the component of near duplicates (by SimHash) as
    cluster. Texts equal but for white space or case are in one component. The measures
    go along as the row's id, so texts are read once and don't move."""
    names = ["_id", "_rid", "_words", "_source"]
    rows = measured(docs, id_col, text_col, source_col, col(text_col).alias("_text"))
    found = grouped(rows.select(F.struct(*names).alias("_row"), "_text"), "_row", "_text", SHINGLE, MAX_BITS, TILE_ROWS)
    return found.select(*(F.col(f"_id.{n}").alias(n) for n in names),
                        F.when(F.col("_id._words") > 0, F.col("_root")).alias("_cluster"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS, near: bool = False) -> DataFrame:
    """(id, ``piece``, ``bin_id``, ``bin_offset``, ``n_words``): one row for each piece of
    each row of ``docs``: its number, bin, first word's place in the bin, and words.

    No bin holds more than ``capacity`` words, two pieces of one source, or two of one
    duplicate cluster (so never two pieces of one document). A cluster is the texts equal
    but for white space, with ``near`` the component of near duplicates. A null source or the
    cluster of a text without words conflicts with nothing. Null, empty and blank texts
    are one piece of no words. Rows that repeat are packed each. Rows of equal length
    are taken in the order of id and cluster. An empty table gives an empty table.
    Extra columns are not read.
    """
    spark = docs.sparkSession
    ready(spark, 4096)
    rows = written((near_measured if near else measured)(docs, id_col, text_col, source_col), "pack-rows")
    shards = max(1, -(-rows.count() // shard_rows))
    order = [F.desc("_words"), "_id", "_cluster", "_source", "_rid"]
    dealt = rows.withColumn("_shard", F.pmod(F.xxhash64("_rid"), F.lit(shards)))
    dealt = dealt.repartition(shards, "_shard").sortWithinPartitions("_shard", *order)
    out = T.StructType([rows.schema["_id"], *(T.StructField(n, T.LongType()) for n in ("_piece", "_bin", "_offset", "_n"))])
    packed = dealt.mapInArrow(_pack_batches(capacity, out.names), out)
    return packed.select(F.col("_id").alias(id_col), F.col("_piece").cast("int").alias("piece"), F.col("_bin").alias("bin_id"),
                         F.col("_offset").alias("bin_offset"), F.col("_n").alias("n_words"))
