"""A bitmap of integer keys, probed in the scan's own stage (JON2, JON5, SNK1, DEL1).

A key list too long for an IN filter would make the big table shuffle to meet it. As a
bitmap, built by Spark's bitmap aggregate (one bit a key, 4 KB for each block of 32,768
numbers that has any), a million consecutive ids are 125 KB: it is broadcast within the
byte bound, every row meets at most the one block its key falls in, and rows that don't
match are gone before any shuffle. Keys too scattered for the bound are joined instead;
the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from unitmesh.plans.joins import CONF_KEY, DEFAULT_MAX_BROADCAST_BYTES
from unitmesh.plans.materialize import materialize

WORDS = 512  # of 64 bits in a block
_BLOCK_BYTES = 8 * WORDS + 64


def places_within(max_bytes: int) -> int:
    """How many numbers from 0 a bitmap of ``max_bytes`` holds, whichever of them are set."""
    return max_bytes // _BLOCK_BYTES * WORDS * 64


class KeyBitmap:
    """The distinct non-null integers of ``keys.column``."""

    def __init__(self, keys: DataFrame, column: str, max_bytes: int | None = None):
        if not isinstance(keys.schema[column].dataType, T.IntegralType):
            raise ValueError(f"{column} is not an integer column")
        k = F.col(column).cast("long")
        blocks = (keys.where(k.isNotNull()).groupBy(F.bitmap_bucket_number(k).alias("_block"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(k)).alias("bits")))
        word = lambda w: F.conv(F.hex(F.substring("bits", w * 8 + 1, F.lit(8))), 16, -10).cast("long")
        self.blocks = materialize(blocks.select("_block", F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), word).alias("_words")), "key-bitmap")
        self.bytes = self.blocks.count() * _BLOCK_BYTES
        if max_bytes is None:
            max_bytes = int(keys.sparkSession.conf.get(CONF_KEY, str(DEFAULT_MAX_BROADCAST_BYTES)))
        self.fits = self.bytes <= max_bytes
        self._keys = keys.select(k.alias("_key")).where("_key is not null").distinct()

    def _probed(self, df: DataFrame, column: str) -> tuple[DataFrame, Column]:
        k = F.col(column).cast("long")
        at = F.bitmap_bit_position(k)
        # the words are big-endian: byte 0 of eight is the highest
        shift = 56 - 8 * F.floor((at % 64) / 8) + at % 8
        bit = F.getbit(F.element_at("_words", (F.floor(at / 64) + 1).cast("int")), shift.cast("int"))
        joined = df.withColumn("_block", F.bitmap_bucket_number(k)).join(F.broadcast(self.blocks), "_block", "left")
        return joined, F.coalesce(bit == 1, F.lit(False))

    def matching(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose ``column`` is among the keys."""
        if not self.fits:
            return df.join(self._keys.withColumnRenamed("_key", column), column, "left_semi").select(*df.columns)
        joined, hit = self._probed(df, column)
        return joined.where(hit).select(*df.columns)

    def without(self, df: DataFrame, column: str) -> DataFrame:
        """Rows whose ``column`` is not among the keys, null ones included."""
        if not self.fits:
            return df.join(self._keys.withColumnRenamed("_key", column), column, "left_anti").select(*df.columns)
        joined, hit = self._probed(df, column)
        return joined.where(~hit).select(*df.columns)
