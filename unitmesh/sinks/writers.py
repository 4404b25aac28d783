"""Sinks: bulk batches (SNK2), warehouse store (SNK4), appends (SNK7), JSON records (SNK8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F



def nest_parent(df: DataFrame) -> DataFrame:
    """Flat ``parent_id`` -> ``parent: {id}`` and an empty ``attributeValues`` list, the
    shape the metadata import expects."""
    out = df
    if "parent_id" in df.columns:
        out = out.withColumn("parent", F.struct(F.col("parent_id").alias("id"))).drop("parent_id")
    if "attributeValues" not in out.columns:
        out = out.withColumn("attributeValues", F.array().cast("array<string>"))
    return out


def write_batches(adds: DataFrame, edits: DataFrame, relocates: DataFrame, out_dir: str) -> dict[str, bool]:
    """SNK2: write the add, edit and relocation batches (NDJSON, one site per line) in
    that order, each only when it has rows. Returns which batches were written."""
    written = {}
    for name, df in (("add", adds), ("edit", edits), ("relocate", relocates)):
        has_rows = not df.isEmpty()
        if has_rows:
            nest_parent(df.drop("row_no") if "row_no" in df.columns else df) \
                .write.mode("overwrite").json(f"{out_dir.rstrip('/')}/{name}")
        written[name] = has_rows
    return written


def store(df: DataFrame, path: str, partition_by: list[str] | None = None,
          cluster_by: list[str] | None = None) -> None:
    """SNK4: write warehouse records as parquet, partitioned (e.g. by period) so later
    reads prune to the periods they need. With ``partition_by`` only the partitions that
    ``df`` has rows of are replaced (dynamic overwrite); without, the whole folder is.
    ``cluster_by`` (e.g. the site column) deals rows by range and sorts them, so each
    file holds a range of few partitions, parquet min/max statistics are tight and a
    filter on those columns (such as the merge's site list) skips row groups."""
    keys = [*(partition_by or []), *(cluster_by or [])]
    if cluster_by:
        df = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    w.parquet(path)


def append(df: DataFrame, path: str) -> None:
    """SNK7: append documents to a collection folder (JSON lines)."""
    df.write.mode("append").json(path)


def json_record(df: DataFrame, keep_nulls: bool = True) -> Column:
    """SNK8 / SCL14: each row as one JSON object; NULL fields are written as ``null`` (as the
    pandas records export does) unless ``keep_nulls`` is false."""
    return F.to_json(F.struct(*[F.col(c) for c in df.columns]),
                     {"ignoreNullFields": "false" if keep_nulls else "true"})


def to_json_records(df: DataFrame, keep_nulls: bool = True) -> DataFrame:
    return df.select(json_record(df, keep_nulls).alias("record"))

