"""Merge requests replayed one after another (MRG1 in request order, chains included).

:func:`unitmesh.operators.merge.merge_values` resolves all sources of a destination
together and refuses chains. Here every request is a call of its own, as when the merges
are run one by one: a destination may later be a source, a source may be filled again,
and AVG of several sources is the average of averages that repeated calls give.

Requests that share no site don't wait for each other. A request's level is one more than
the highest level of the earlier requests that share a site with it, so requests of one
level touch different sites and are merged in one fold. A value row is read and written
once per fold it takes part in: rows lie in partitions of the level that touches their site
next, and a fold reads only its own partition and appends its rows to later ones.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from unitmesh.operators.merge import merge_values
from unitmesh.plans.joins import is_small, join_small, prefilter
from unitmesh.plans.materialize import materialize
from unitmesh.schemas import DATAVALUE_COLUMNS
from unitmesh.session import scratch_path

DONE = 0  # the partition of rows that no later request touches
_REQUEST = ["request_no", "source_id", "dest_id", "strategy"]


@dataclass
class ReplayResult:
    staged: DataFrame   # rows that replace all rows of the touched sites
    lost: DataFrame     # live rows that a fold drops, with the level that did
    sites: DataFrame    # (sourceid) of every touched site
    levels: DataFrame   # the requests with their level (from 1)
    sites_small: bool = False  # the touched-site list is within the broadcast bound


def _touches(requests: DataFrame, *columns: str) -> DataFrame:
    return (requests.select(F.col("source_id").alias("site"), *columns)
            .unionByName(requests.select(F.col("dest_id").alias("site"), *columns)))


def merge_levels(requests: DataFrame) -> tuple[DataFrame, int]:
    """The requests with their ``level`` (from 1), and the highest level.

    Each round takes the requests that come first at both of their sites: a minimum per
    site, a partial aggregate however many requests one site has. There are as many rounds
    as folds. Equal request numbers are ordered by source, destination and strategy;
    a request that repeats whole counts once. A null id or a site merged with itself
    is an error.
    """
    order = F.struct(*_REQUEST)
    bad = F.col("source_id").isNull() | F.col("dest_id").isNull() | (F.col("source_id") == F.col("dest_id"))
    if not requests.where(bad).isEmpty():
        raise ValueError("merge requests need two different sites each")
    path, level = scratch_path(requests.sparkSession, "merge-levels"), 0
    pending = requests.select(*_REQUEST).distinct()
    while True:
        first = _touches(pending.withColumn("_no", order), "_no").groupBy("site").agg(F.min("_no").alias("_first"))
        marked = materialize(
            pending.join(first.select(F.col("site").alias("source_id"), F.col("_first").alias("_s")), "source_id")
            .join(first.select(F.col("site").alias("dest_id"), F.col("_first").alias("_d")), "dest_id")
            .select(*_REQUEST, (F.col("_s").eqNullSafe(order) & F.col("_d").eqNullSafe(order)).alias("_ready")), "merge-pending")
        ready = marked.where("_ready").select(*_REQUEST, F.lit(level + 1).alias("level"))
        ready.write.mode("append").parquet(path)
        pending = marked.where("not _ready").drop("_ready")
        if ready.isEmpty():
            break
        level += 1
    return requests.sparkSession.read.schema(ready.schema).parquet(path), level


def replay_merges(datavalue: DataFrame, dataelement: DataFrame, requests: DataFrame, run_ts: str,
                  cast_mode: str = "ansi") -> ReplayResult:
    """Apply merge ``requests`` (``request_no``, ``source_id``, ``dest_id``, ``strategy``) in
    the order of their numbers; the result equals one merge call per request.

    The rules of each fold are those of ``merge_values``, with ``run_ts`` as the time of
    all. The number of folds is the longest chain of requests that share sites one after
    another: k sources of one destination take k folds, as each works on the outcome of
    the one before. Use ``merge_values`` where they are to be resolved together.
    """
    spark = datavalue.sparkSession
    levels, last = merge_levels(requests)
    by_site = Window.partitionBy("site").orderBy("level")  # a site has one request a level
    route = materialize(_touches(levels, "level").distinct()
                        .withColumn("next", F.coalesce(F.lead("level").over(by_site), F.lit(DONE))), "merge-routes")
    entry = materialize(route.groupBy(F.col("site").alias("sourceid")).agg(F.min("level").alias("_level")), "merge-entry")
    path, lost_path = scratch_path(spark, "merge-rows"), scratch_path(spark, "merge-lost")
    base = datavalue.select(*DATAVALUE_COLUMNS)
    rows = join_small(prefilter(base, "sourceid", entry), entry, "sourceid").select(*DATAVALUE_COLUMNS, "_level")
    rows.write.partitionBy("_level").parquet(path)
    stored = lambda: spark.read.schema(rows.schema).parquet(path)
    lost = None
    for level in range(1, last + 1):
        mine = levels.where(F.col("level") == level).select("source_id", "dest_id", "strategy")
        fold = merge_values(stored().where(F.col("_level") == level).drop("_level"), dataelement, mine, None, run_ts, cast_mode)
        onward = route.where(F.col("level") == level).select(F.col("site").alias("sourceid"), F.col("next").alias("_level"))
        join_small(fold.staged, onward, "sourceid").select(*DATAVALUE_COLUMNS, "_level").write.mode("append").partitionBy("_level").parquet(path)
        lost = fold.lost.withColumn("level", F.lit(level))
        lost.write.mode("append").parquet(lost_path)
    if lost is None:  # no request: the empty outcome has the same columns
        lost = base.limit(0).select("*", F.lit(0).alias("dest"), F.lit("").alias("reason"), F.lit(0).alias("level"))
        lost.write.parquet(lost_path)
    return ReplayResult(
        staged=stored().where(F.col("_level") == DONE).drop("_level"), lost=spark.read.schema(lost.schema).parquet(lost_path),
        sites=entry.select("sourceid"), levels=levels, sites_small=is_small(entry))
