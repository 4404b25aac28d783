"""Tables stored in buckets of a key (SNK1, DEL1): a change rewrites only the buckets that
hold the keys it touches.

A stored table is a Parquet folder partitioned by ``bucket``, a hash of its key column
modulo a fixed number. The keys of a change give the buckets to read (a partition filter,
so no other file is opened) and to write. The new rows are written to the shared
checkpoint folder first and then replace the old ones bucket by bucket (dynamic partition
overwrite), so a job that is run again starts from complete inputs and ends with the same
store. A bucket that loses all its rows is removed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from unitmesh.operators.merge import replace_sites
from unitmesh.plans.materialize import materialize

BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _put(df: DataFrame, path: str, mode: str) -> None:
    # rebalance deals a bucket with many rows to several tasks and files
    (df.hint("rebalance", BUCKET).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))


def write_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Store ``df`` anew in buckets of ``key``; the number of buckets stays with the caller."""
    df = df.withColumn(BUCKET, bucket_of(key, buckets))
    df.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str, schema, keys: DataFrame | None = None, key: str | None = None,
                 buckets: int | None = None) -> DataFrame:
    """The stored table (columns of ``schema``); with ``keys`` only their buckets."""
    df = spark.read.schema(f"{_ddl(schema)}, {BUCKET} int").parquet(path)
    return df if keys is None else df.where(F.col(BUCKET).isin(touched_buckets(keys, key, buckets)))


def _ddl(schema) -> str:
    return schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def touched_buckets(keys: DataFrame, key: str, buckets: int) -> list[int]:
    """Numbers of the buckets that hold ``keys``: at most ``buckets`` integers."""
    return sorted(r[0] for r in keys.select(bucket_of(key, buckets).alias("b")).distinct().collect())




def change_buckets(spark: SparkSession, path: str, schema, keys: DataFrame, key: str, buckets: int,
                   change: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Replace the rows of the buckets that ``keys`` touch by ``change`` of them (same
    columns, rows of these buckets only). Returns the buckets. Running it again gives the
    same store if ``change`` applied to its own result gives that result."""
    at = touched_buckets(keys, key, buckets)
    if not at:
        return at
    old = spark.read.schema(f"{_ddl(schema)}, {BUCKET} int").parquet(path).where(F.col(BUCKET).isin(at)).drop(BUCKET)
    new = materialize(change(old).withColumn(BUCKET, bucket_of(key, buckets)), "bucket-rows")
    _put(new, path, "overwrite")
    left = {r[0] for r in new.select(BUCKET).distinct().collect()}  # at most the buckets touched
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for b in at:
        if b not in left:
            folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{BUCKET}={b}")
            folder.getFileSystem(conf).delete(folder, True)
    return at


def replace_sites_stored(spark: SparkSession, path: str, schema, staged: DataFrame, sites: DataFrame, buckets: int) -> list[int]:
    """SNK1 on a stored value table: all rows of the touched sites (``sourceid``) replaced by
    ``staged``, rewriting only the sites' buckets. ``staged`` must not read the store at
    ``path`` when this runs again (write it first)."""
    staged = materialize(staged, "bucket-staged")
    return change_buckets(spark, path, schema, sites.unionByName(staged.select("sourceid")), "sourceid", buckets,
                          lambda old: replace_sites(old, staged, sites))


def delete_keys_stored(spark: SparkSession, path: str, schema, keys: DataFrame, key: str, buckets: int) -> list[int]:
    """DEL1 on a stored table: the rows of ``keys`` go, rewriting only their buckets."""
    gone = materialize(keys.select(key).distinct(), "bucket-gone")
    return change_buckets(spark, path, schema, gone, key, buckets, lambda old: old.join(gone, key, "left_anti"))
