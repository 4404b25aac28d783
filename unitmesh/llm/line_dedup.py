"""Line deduplication over a corpus.

Lines are normalised, hashed to 128 bits and exploded to (hash, document); the number
of distinct documents of each hash is counted with two partial aggregations; hashes at
the threshold lose their lines in every document but the one with the largest id; the
remaining lines of each document are put together again in their order.

Only hashes are shuffled for the count, and a hash that a third of all documents hold
is summed before the shuffle. The texts move once, to meet the list of hashes their
document has to drop. The join of (hash, document) with the dropped hashes reads two
written tables, so AQE can split a hot hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from unitmesh.llm.common import packed, ready, unpacked, written

MIN_CHARS = 40
MIN_DOCUMENTS = 5
# ASCII white space, as bytes.strip() takes it: \x20 and \x09-\x0D.
_EDGE = b" \t\n\x0b\x0c\r"


def line_hashes(lines: list[bytes], min_chars: int) -> list[bytes | None]:
    """128-bit hash of each line's key (stripped, A-Z lower-cased), None if the key is
    shorter than ``min_chars`` code points."""
    import xxhash

    out: list[bytes | None] = []
    for line in lines:
        key = line.strip(_EDGE).lower()
        # code points: bytes that do not continue a UTF-8 sequence
        long_enough = len(key) >= min_chars and (
            key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars)
        out.append(xxhash.xxh3_128_digest(key) if long_enough else None)
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _hash_batches(min_chars: int):
    def run(batches):
        for batch in batches:
            rows, found = [], []
            for i, text in enumerate(_texts(batch.column(1))):
                own = {h for h in line_hashes(text.split(b"\n"), min_chars) if h is not None}
                found.extend(own)
                rows.append(np.full(len(own), i, dtype=np.int64))
            take = pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), pa.array(found, pa.binary())], names=["_id", "_hash"])
    return run


def _drop_batches(min_chars: int, names: list[str]):
    def run(batches):
        for batch in batches:
            at = {n: batch.column(k) for k, n in enumerate(batch.schema.names)}
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(_texts(at["_text"]), at["_drop"].to_pylist(), strict=True):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if not drop:
                    texts.append(text)
                    n_dropped.append(0)
                    continue
                gone = set(drop)
                kept = [x for x, h in zip(lines, line_hashes(lines, min_chars), strict=True)
                        if h is None or h not in gone]
                texts.append(b"\n".join(kept))
                n_dropped.append(len(lines) - len(kept))
            at |= {"_kept": pa.array(texts, pa.binary()).cast(pa.string()),
                   "_n_lines": pa.array(n_lines, pa.int64()), "_n_dropped": pa.array(n_dropped, pa.int64())}
            yield pa.RecordBatch.from_arrays([at[n] for n in names], names=names)
    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, report: bool = True) -> DataFrame:
    """``docs`` with repeated lines removed from the text, plus ``n_lines`` (before) and
    ``n_dropped``.

    A line's key is the line without ASCII white space at its ends, A-Z lower-cased.
    Keys of at least ``min_chars`` code points found in at least ``min_documents``
    documents lose all their lines except in the document with the largest id.

    A null or empty text is one empty line and comes back as the empty text. A document
    is an id: rows that repeat an id count once and are treated alike; null ids count
    as one document that is smaller than any other. An empty table gives an empty
    table. Other columns pass through; ``n_lines`` and ``n_dropped`` replace input
    columns of the same name, unless ``report`` is off: then only the columns of
    ``docs`` come back.
    """
    spark = docs.sparkSession
    ready(spark)
    parts = {"_id": id_col, "_text": text_col}
    rows = packed(docs, parts)
    pair = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_hash", T.BinaryType())])
    lines = written(
        rows.select("_id", "_text").mapInArrow(_hash_batches(min_chars), pair)
        .groupBy("_hash", "_id").agg(F.lit(True).alias("_seen")).select("_hash", "_id"), "line-hashes")
    repeated = written(
        lines.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"), F.max("_id").alias("_keeper"))
        .where(F.col("_n") >= min_documents).select("_hash", "_keeper"), "line-repeated")
    drops = (lines.join(repeated, "_hash").where(~F.col("_id").eqNullSafe(F.col("_keeper")))
             .groupBy("_id").agg(F.collect_list("_hash").alias("_drop"))
             .withColumnRenamed("_id", "_of"))
    joined = rows.join(drops, F.col("_id").eqNullSafe(F.col("_of")), "left").drop("_of")
    out = T.StructType([f for f in rows.schema.fields if f.name != "_text"] + [
        T.StructField("_kept", T.StringType()), T.StructField("_n_lines", T.LongType()),
        T.StructField("_n_dropped", T.LongType())])
    done = joined.mapInArrow(_drop_batches(min_chars, out.names), out)
    return unpacked(done, docs, {"_id": id_col, "_kept": text_col},
                    {"n_lines": "_n_lines", "n_dropped": "_n_dropped"} if report else {})
