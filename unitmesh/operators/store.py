"""Key-value document store on DataFrames: put (SNK5), latest per key (WIN5 / SRC8),
update one field (SNK6).

A store is a table of versions ``(key, document, ts, seq)``; writes append versions
and reads pick the latest per key. The latest version is a ``max`` over
``struct(ts, seq, document)`` per key: a partial (map-side) aggregate, so a key
with millions of versions costs one row per map task in the shuffle, never a
window over all its versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from unitmesh.plans.joins import prefilter


def kv_put(store: DataFrame, items: DataFrame) -> DataFrame:
    """SNK5: append new versions ``(key, document, ts, seq)``; a later version of a key
    overwrites it on read."""
    return store.unionByName(items.select(*store.columns))


def kv_latest(store: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """WIN5 / SRC8: the latest version per key (largest ts, then seq). With ``keys``
    only those keys are read (semi-join before the aggregate)."""
    if keys is None:
        s = store
    else:
        k = keys.select("key").distinct()
        s = prefilter(store, "key", k).join(k, "key", "left_semi")
    best = s.groupBy("key").agg(F.max(F.struct("ts", "seq", "document")).alias("_v"))
    return best.select("key", F.col("_v.document").alias("document"), F.col("_v.ts").alias("ts"),
                       F.col("_v.seq").alias("seq"))


def set_field(document: str, field: str, value_json: str):
    """Column: JSON object text with ``field`` set to the JSON value ``value_json``
    (other fields kept, of a repeated field the last; the output lists fields in sorted
    order). A document that is not a JSON object (array, scalar, invalid text) has no fields to set and is
    returned unchanged instead of failing the job."""
    m = F.try_parse_json(F.col(document)).try_cast("map<string, variant>")
    kept = F.map_filter(m, lambda k, v: k != F.lit(field))
    new = F.create_map(F.lit(field), F.parse_json(F.lit(value_json)))
    updated = F.to_json(F.to_variant_object(F.map_concat(kept, new)))
    return F.when(m.isNull(), F.col(document)).otherwise(updated)


def kv_update(store: DataFrame, field: str, value_json: str, ts, seq: int = 0,
              keys: DataFrame | None = None) -> DataFrame:
    """SNK6: for every key (or the given ``keys``), the latest document with one field
    set, as new versions to append with :func:`kv_put`."""
    latest = kv_latest(store, keys)
    return latest.select("key", set_field("document", field, value_json).alias("document"),
                         F.lit(ts).cast(store.schema["ts"].dataType).alias("ts"),
                         F.lit(seq).cast(store.schema["seq"].dataType).alias("seq"))


def kv_unreadable(store: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """The latest versions whose document is not a JSON object, which :func:`kv_update`
    leaves as they are."""
    latest = kv_latest(store, keys)
    return latest.where(F.try_parse_json("document").try_cast("map<string, variant>").isNull())
