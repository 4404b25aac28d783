"""Helpers shared by the operators: internal row layout, Arrow batches, written tables."""

from __future__ import annotations

from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from unitmesh.session import prepare, scratch_path

# Rows per Arrow batch for operators that pass whole texts to Python: a batch of this
# many very long documents still fits in a worker beside the executor's heap.
TEXT_ROWS_PER_BATCH = 256
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ready(spark: SparkSession, rows_per_batch: int = TEXT_ROWS_PER_BATCH) -> None:
    """Checkpoint folder, shipped code and small Arrow batches for this session."""
    prepare(spark)
    now = int(spark.conf.get(_ARROW_ROWS, "10000"))
    if now <= 0 or now > rows_per_batch:
        spark.conf.set(_ARROW_ROWS, str(rows_per_batch))


@contextmanager
def arrow_rows(spark: SparkSession, rows_per_batch: int):
    """Smaller Arrow batches for the eager writes inside; the setting is put back after."""
    before = spark.conf.get(_ARROW_ROWS)
    spark.conf.set(_ARROW_ROWS, str(rows_per_batch))
    try:
        yield
    finally:
        spark.conf.set(_ARROW_ROWS, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared checkpoint folder. It cuts the lineage,
    fixes generated row ids, and gives joins plain scans on both sides, which lets AQE
    split a hot key."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def name_of(column: str) -> str:
    """A column name quoted, so that dots in it are not field access."""
    return "`" + column.replace("`", "``") + "`"


def col(column: str):
    return F.col(name_of(column))


def packed(df: DataFrame, parts: dict[str, str]) -> DataFrame:
    """Internal names for the columns an operator works on (``parts``: internal name to
    column) and everything else in one struct ``_rest``, so no extra column can clash."""
    rest = [col(c) for c in df.columns if c not in parts.values()]
    cols = [col(c).alias(k) for k, c in parts.items()]
    return df.select(*cols, *([F.struct(*rest).alias("_rest")] if rest else []))


def unpacked(df: DataFrame, like: DataFrame, parts: dict[str, str], results: dict[str, str]) -> DataFrame:
    """The columns of ``like`` in their order, then ``results`` (output name to internal
    name). A result replaces an input column of the same name."""
    back = {c: k for k, c in parts.items()}
    cols = []
    for c in like.columns:
        if c in results:
            continue
        cols.append((F.col(back[c]) if c in back else F.col("_rest." + name_of(c))).alias(c))
    return df.select(*cols, *(F.col(k).alias(c) for c, k in results.items()))


def hash_sample(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest hash of ``key`` (all, if fewer), which must differ
    between rows: rows of one key have one place. Rows beyond twice
    that share of the hashes are filtered out before the sort, so that the one task that
    merges the order gets a bounded number of rows however large the table is."""
    total = rows.count()
    place = F.pmod(F.xxhash64(key), F.lit(1 << 53))
    if total > n:
        rows = rows.where(place < int((1 << 53) * min(1.0, (2 * n + 100) / total)))
    return rows.orderBy(place, key).limit(n)


def byte_class(chars: bytes) -> np.ndarray:
    """Ones at the given byte values: a row of a matrix whose product with a text's byte
    histogram gives the class's count."""
    out = np.zeros(256)
    out[list(chars)] = 1
    return out
