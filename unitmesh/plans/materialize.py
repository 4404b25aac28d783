"""Materialise an intermediate result as a table in the shared checkpoint folder.

Used where a plan would otherwise scan a large input twice (aggregate, then join
back to the rows): the filtered rows are written once and both branches read the
written table. A written table also cuts the lineage, so a lost executor only costs
re-reading files, not recomputing the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from unitmesh.session import scratch_path


def materialize(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
