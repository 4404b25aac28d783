"""Connected components of a link table by alternating large and small stars.

Every round is two partial aggregations (the smallest neighbour of each node) and two
joins with their written result; both sides of the joins are plain scans, so AQE can
split the links of a hub. Rounds end when the links no longer change; after that each
node is linked to its component's smallest node only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from unitmesh.llm.common import written


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Large star (``both``): every node links its larger neighbours to the smallest of
    its neighbourhood. Small star: every node links its smaller neighbours and itself
    to the smallest of them. Links are (u, v) with u > v."""
    around = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else links
    least = written(around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "star-least")
    met = around.join(least, "u")
    if both:
        out = met.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return written(out.where(F.col("u") > F.col("v")).distinct(), "star-links")


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(``node``, ``root``) for every node of a link between two different nodes; the
    root is the smallest node of the component. Null ends and self links are ignored;
    an empty table gives an empty table."""
    now = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "star-links")
    state = _state(now)
    while state[0]:
        now = _star(_star(now, True), False)
        new = _state(now)
        if new == state:
            break
        state = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
