"""Name similarity of paired names (UDF1, SCL13) and exact name matching (JON11).

The reference scores one (left, right) pair at a time and calls it a match only at
100, i.e. equal strings. Scoring is done on pairs that some key already aligns
(one right name per left row); matching a name list against another is an
equi-join on the name, with the right side first reduced to one row per name, so
each left row meets at most one partner however often a name repeats. No pair
enumeration within a group, no cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from unitmesh.functions.jaro import match_score
from unitmesh.plans.joins import join_small


def score_pairs(pairs: DataFrame, left: str = "left_name", right: str = "right_name") -> DataFrame:
    """``pairs`` plus ``match_value`` (Jaro x 100) and ``matched`` (= 100)."""
    score = match_score(F.col(left), F.col(right))
    return pairs.withColumn("match_value", score).withColumn("matched", F.col("match_value") == 100.0)


def match_names(left: DataFrame, right: DataFrame, left_name: str, right_name: str,
                right_id: str) -> DataFrame:
    """JON11: each left row with the right record of exactly the same name (smallest
    id when several share it) and how many right records carry that name."""
    reps = (right.groupBy(F.col(right_name).alias("_name"))
            .agg(F.min(right_id).alias("matched_id"), F.count(F.lit(1)).alias("n_same_name")))
    j = join_small(left.withColumn("_name", F.col(left_name)), reps, "_name", "left")
    return (j.drop("_name")
            .withColumn("n_same_name", F.coalesce(F.col("n_same_name"), F.lit(0)))
            .withColumn("matched", F.col("matched_id").isNotNull()))
