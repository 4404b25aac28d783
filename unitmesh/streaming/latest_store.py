"""Key-value store kept by a stream (SNK5, WIN5, REG2): the latest document of every key.

The stream reads versions (key, document, ts, seq) from a folder that files are added to.
Each micro-batch is reduced to its latest version per key (a partial aggregate) and merged
into a store in buckets of the key, rewriting only the buckets its keys touch. The merge
keeps the larger of two versions by (ts, seq, document), so it does not matter whether a
batch is applied once or, after a lost driver or a replay, again, nor in which order:
the store is the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from unitmesh.operators.buckets import change_buckets, read_buckets, write_buckets
from unitmesh.operators.store import kv_latest
from unitmesh.plans.materialize import materialize

BUCKETS = 32


def create_store(spark: SparkSession, path: str, schema: str, buckets: int = BUCKETS) -> None:
    """An empty store for versions of ``schema`` (key, document, ts, seq)."""
    write_buckets(spark.createDataFrame([], schema), path, "key", buckets)


def apply_versions(versions: DataFrame, path: str, schema: str, buckets: int = BUCKETS) -> list[int]:
    """Merge versions into the store; returns the buckets rewritten. Rows without a key are
    left out."""
    new = materialize(kv_latest(versions.where("key is not null")).select("key", "document", "ts", "seq"), "store-batch")
    return change_buckets(new.sparkSession, path, schema, new, "key", buckets,
                          lambda old: kv_latest(old.unionByName(new)).select("key", "document", "ts", "seq"))


def run_latest_store(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str, buckets: int = BUCKETS,
                     fmt: str = "parquet", available_now: bool = True):
    """Start the stream over ``source``; with ``available_now`` wait until the backlog is
    done. Returns the StreamingQuery."""
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda batch, _: apply_versions(batch, path, schema, buckets)))
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return q


def read_store(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """(key, document, ts, seq): the latest version of every key."""
    return read_buckets(spark, path, schema).select("key", "document", "ts", "seq")
