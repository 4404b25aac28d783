"""Join helpers: broadcast a side only when its size in bytes is known to be small.

A broadcast ships the whole side to every executor. A side gets the hint only if the
optimizer's size of its plan, an upper bound from the bytes of the files it reads, is
within a limit; no job runs for that. Any other side is left to the planner, which
shuffles (sort-merge join); AQE may still switch to a broadcast at run time from
measured shuffle bytes, and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from unitmesh.plans.materialize import materialize

# Default bound in bytes of a broadcast side.
DEFAULT_MAX_BROADCAST_BYTES = 16 * 1024 * 1024
CONF_KEY = "unitmesh.broadcast.maxBytes"


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's upper bound on the size of ``df``, from file sizes; no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether ``df`` is within the broadcast bound. A side derived from a small input by
    projection, aggregation or semi-join is no larger, so one check can cover all of
    them (see :func:`broadcast_if`)."""
    if max_bytes is None:
        max_bytes = int(df.sparkSession.conf.get(CONF_KEY, str(DEFAULT_MAX_BROADCAST_BYTES)))
    return plan_bytes(df) <= max_bytes


def broadcast_if(df: DataFrame, proven_small: bool) -> DataFrame:
    """Broadcast hint on ``df`` when the input it derives from is known to be small."""
    return F.broadcast(df) if proven_small else df


def small_side(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Return ``df`` with a broadcast hint if its size is within the bound."""
    return broadcast_if(df, is_small(df, max_bytes))


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_bytes: int | None = None) -> DataFrame:
    """``big.join(small)`` broadcasting ``small`` only behind the size check."""
    return big.join(small_side(small, max_bytes), on, how)


# Largest id list added as a literal IN filter (pushed into the parquet scan).
DEFAULT_MAX_IN_LIST = 10_000
IN_LIST_KEY = "unitmesh.pushdown.maxInList"


def key_values(keys: DataFrame, column: str, max_values: int | None = None) -> list | None:
    """The distinct values of ``column`` if there are at most ``max_values`` of them
    (one bounded job: reads at most max_values + 1 distinct values), else None."""
    bound = max_values if max_values is not None else int(
        keys.sparkSession.conf.get(IN_LIST_KEY, str(DEFAULT_MAX_IN_LIST)))
    got = keys.select(column).where(F.col(column).isNotNull()).distinct().limit(bound + 1).collect()
    return None if len(got) > bound else [r[0] for r in got]


def prefilter(big: DataFrame, column: str, keys: DataFrame, key_column: str | None = None,
              max_values: int | None = None) -> DataFrame:
    """``big`` restricted to rows whose ``column`` is among the keys, as a literal
    ``isin`` filter that reaches the parquet scan (row groups whose min/max miss
    every key are skipped), when the key list is short; otherwise ``big`` unchanged.
    A filter only: the join that needs the keys' other columns still follows."""
    values = key_values(keys, key_column or column, max_values)
    return big if values is None else big.where(F.col(column).isin(values))


def split_repeated(rows: DataFrame, key_hash: Column) -> tuple[DataFrame, DataFrame | None]:
    """(rows that may share their key with another row, rows that share it with none).

    Only the hashes are shuffled, eight bytes a row, and counted; the repeated ones are
    broadcast within the byte bound, and each row is told in the scan's own stage. Longer
    lists are broadcast as a bitmap of as many places as the bound allows
    (:class:`unitmesh.plans.bitmaps.KeyBitmap`): a place stands for several hashes, so some
    rows alone under their key meet a bit of others and go to the first part. A NULL
    hash counts as alone. The first part is a written table; it holds all rows of every
    repeated key, and rows of different keys that share a hash or a place, so keys still
    have to be compared there. Where the bound does not hold one block of a bitmap all rows
    are in the first part, not written, and the second is None.
    """
    from unitmesh.plans import bitmaps

    each = rows.select(key_hash.alias("_hash")).where("_hash is not null").groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(each.where("_n > 1").select("_hash"), "repeated-keys")
    hashed = rows.withColumn("_hash", key_hash)
    if is_small(repeated):
        repeated = F.broadcast(repeated)
        shared, alone = (hashed.join(repeated, "_hash", how) for how in ("left_semi", "left_anti"))
    else:
        places = bitmaps.places_within(int(rows.sparkSession.conf.get(CONF_KEY, str(DEFAULT_MAX_BROADCAST_BYTES))))
        if not places:
            return rows, None
        at = F.pmod(F.col("_hash"), F.lit(places).cast("long"))
        taken = repeated.select(at.alias("_hash")).repartition(F.bitmap_bucket_number("_hash"))  # a block's bits are set in one task
        bits, hashed = bitmaps.KeyBitmap(taken, "_hash"), hashed.withColumn("_hash", at)
        shared, alone = bits.matching(hashed, "_hash"), bits.without(hashed, "_hash")
    return materialize(shared.drop("_hash"), "repeated-rows"), alone.drop("_hash")
