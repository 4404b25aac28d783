"""Row numbers within groups without putting a whole group into one task.

``row_number() over (partition by g order by o)`` needs every row of a group in one
task; one group holding a third of the table would then run on a single core. Here
the rows are range-partitioned on (g, o) instead, so Spark's sampled bounds split a
large group over several partitions, and each row's number is its position inside
its partition plus the number of rows of its group in earlier partitions:

1. range exchange on (g, o) and a sort inside each partition (one shuffle), with
   partition id and position written once to the checkpoint folder;
2. per (partition, group): first position and row count (small aggregate);
3. running total of those counts over the partitions of each group (small window);
4. join the offsets back. The offsets come out of a shuffle, so AQE knows their
   exact size at run time and broadcasts them when small (no extra probe job).

The ordering columns must make rows unique within a group, so that the sort, and
with it every number, is the same if a task is re-run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from unitmesh.plans.materialize import materialize


def row_numbers(df: DataFrame, group: list[str], order: list[str], out: str = "row_number",
                partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based row number within ``group`` ordered by ``order``."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = group + order
    # Written once: the statistics and the rows must see the same partition ids and
    # positions, whatever AQE does to either read and whichever task is re-run.
    ranged = materialize(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
                         .withColumn("_pid", F.spark_partition_id())
                         .withColumn("_pos", F.monotonically_increasing_id()), "numbered")
    stats = ranged.groupBy("_pid", *group).agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_cnt").over(w), F.lit(0)))
    # Null-safe on the group columns, so rows of a NULL group are numbered too.
    st = stats.select(F.col("_pid").alias("_s_pid"), *[F.col(g).alias(f"_s_{g}") for g in group], "_first", "_before")
    cond = [ranged["_pid"] == st["_s_pid"]] + [ranged[g].eqNullSafe(st[f"_s_{g}"]) for g in group]
    joined = ranged.join(st, cond, "inner")
    return (joined.withColumn(out, F.col("_before") + (F.col("_pos") - F.col("_first")) + 1)
            .drop("_pid", "_pos", "_first", "_before", "_s_pid", *[f"_s_{g}" for g in group]))


def running_sums(df: DataFrame, group: list[str], order: list[str], value: str, out: str,
                 partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = sum of ``value`` over the rows of ``group`` that come before the
    row by ``order`` (0 for the first), with the same range exchange as above: a window
    only ever holds the rows of one group in one of its partitions."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = group + order
    ranged = materialize(df.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()), "summed")
    stats = ranged.groupBy("_pid", *group).agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
    st = stats.select(F.col("_pid").alias("_s_pid"), *[F.col(g).alias(f"_s_{g}") for g in group], "_before")
    own = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_own", F.coalesce(F.sum(value).over(own), F.lit(0)))
    cond = [local["_pid"] == st["_s_pid"]] + [local[g].eqNullSafe(st[f"_s_{g}"]) for g in group]
    return (local.join(st, cond).withColumn(out, F.col("_before") + F.col("_own"))
            .drop("_pid", "_own", "_before", "_s_pid", *[f"_s_{g}" for g in group]))
