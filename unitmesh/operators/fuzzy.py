"""Thresholded fuzzy name join (JON11 with the score of UDF1): filter and verify.

A Jaro similarity of at least t needs at least (3t - 1) / (1/|a| + 1/|b|) common
characters, whatever their order. That gives filters that lose no pair:

* lengths: the shorter name has at least 3t - 2 of the longer one's characters;
* rare tokens: a name's characters, counted (the second ``e`` is another token than the
  first), are ordered by how few names have them. Two names that share n tokens share one
  among the first |name| - n + 1 of each, so names meet by an equi-join on these tokens.
  How many that are depends on the partner's length: a name stands once under each class
  of lengths a partner can have (exact up to 32 characters, beyond that 5 % wide), with as
  many tokens as that class makes necessary;
* missing tokens: how many of one side the other lacks, bounded from below by popcounts of
  token bitmaps, as a condition of the join itself. What does not pass never leaves it.

Only distinct names are joined. Keys that many names have are dealt to a grid of tiles, so
no task compares more than about ``TILE`` names a side under one key. Survivors are
verified with Jaro itself, many pairs at a time.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from unitmesh.functions.jaro import match_score
from unitmesh.plans.joins import join_small
from unitmesh.plans.materialize import materialize
from unitmesh.session import prepare

TILE = 4096
EXACT, WIDER = 32, 1.05  # lengths with a class of their own; growth of the classes beyond
DIGITS = 6
_BITS = 128


def _least(threshold: float) -> float:
    """3t - 1 for a threshold in hundredths, less what rounding the score may add."""
    return 3 * (threshold - 10.0 ** -DIGITS) / 100 - 1


def needed(la: Column, lb: Column, threshold: float) -> Column:
    """Least number of common characters of names of these lengths."""
    return F.greatest(F.lit(1), F.ceil(F.lit(_least(threshold)) / (1 / la + 1 / lb) - 1e-9).cast("int"))


def _class_of(n: Column) -> Column:
    return F.when(n <= EXACT, n).otherwise(EXACT + F.floor(F.log(n / F.lit(float(EXACT))) / F.log(F.lit(WIDER)))).cast("int")


def _shortest(c: Column) -> Column:
    """A length that no name of the class is shorter than."""
    return F.when(c <= EXACT, c).otherwise(F.greatest(F.lit(EXACT), F.floor(EXACT * F.pow(F.lit(WIDER), c - EXACT)) - 1)).cast("int")


def _described(batches):
    """(side, nid, len, b1, b2, tokens) of every name (side, nid, name)."""
    for batch in batches:
        size, low, high, tokens = [], [], [], []
        for name in batch.column(2).to_pylist():
            seen: Counter = Counter()
            bits, own = 0, []
            for c in name:
                own.append((ord(c) << 32) + seen[c])
                bits |= 1 << ((ord(c) + 37 * seen[c]) % _BITS)
                seen[c] += 1
            words = np.array([bits & (2 ** 64 - 1), bits >> 64], np.uint64).view(np.int64)
            for column, value in ((size, len(own)), (low, int(words[0])), (high, int(words[1])), (tokens, own)):
                column.append(value)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int32()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                                          pa.array(tokens, pa.list_(pa.int64()))], names=["side", "nid", "len", "b1", "b2", "tokens"])


def prefix_rows(names: DataFrame, threshold: float) -> DataFrame:
    """(token, ca, cb, side, nid, len, b1, b2): the names (side, nid, name) under each class
    of partners and each token necessary there; ``ca`` and ``cb`` are the length classes of
    the left (side 0) and the right name."""
    known = materialize(names.mapInArrow(_described, "side int, nid long, len int, b1 long, b2 long, tokens array<long>"), "fuzzy-tokens")
    each = known.select("side", "nid", "len", "b1", "b2", F.explode("tokens").alias("token"))
    rarity = materialize(each.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "fuzzy-rarity")
    ordered = (join_small(each, rarity, "token").groupBy("side", "nid", "len", "b1", "b2")
               .agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("t")))
    ratio = _least(threshold) - 1  # shorter / longer at least
    n = F.col("len")
    first = F.greatest(F.lit(1), F.ceil(n * F.lit(ratio) - 1e-9)).cast("int")
    last = F.floor(n / F.lit(ratio) + 1e-9).cast("int") if ratio > 0 else F.lit(1 << 30)
    # Only classes that the other side has: at most a few hundred in all.
    classes = known.groupBy("side").agg(F.collect_set(_class_of(n)).alias("there")).select((1 - F.col("side")).alias("side"), "there")
    partner = F.explode(F.filter("there", lambda c: (c >= _class_of(first)) & (c <= _class_of(last))))
    met = ordered.join(F.broadcast(classes), "side").withColumn("c", partner)
    least = needed(n, F.greatest(first, _shortest(F.col("c"))), threshold)
    own = _class_of(n)
    left = F.col("side") == 0
    return (met.withColumn("ca", F.when(left, own).otherwise(F.col("c"))).withColumn("cb", F.when(left, F.col("c")).otherwise(own))
            .select(F.explode(F.slice("t", 1, F.greatest(F.lit(0), n - least + 1))).alias("t"), "ca", "cb", "side", "nid", "len", "b1", "b2")
            .select("t.token", "ca", "cb", "side", "nid", "len", "b1", "b2"))


def _lacking(*words: tuple[str, str]) -> Column:
    """At least so many tokens of the first name are missing in the second."""
    return sum((F.bit_count(F.col(a).bitwiseAND(F.bitwise_not(F.col(b)))) for a, b in words[1:]),
               F.bit_count(F.col(words[0][0]).bitwiseAND(F.bitwise_not(F.col(words[0][1])))))


def fuzzy_pairs(left: DataFrame, right: DataFrame, left_name: str, right_name: str, threshold: float = 90.0) -> DataFrame:
    """(left_name, right_name, match_value) for all pairs of distinct names, one of each
    side, whose Jaro similarity x 100, rounded to six digits, is at least ``threshold``
    (above 0). NULL and empty names match nothing. Compares code points."""
    if threshold <= 0:
        raise ValueError("the threshold must be above 0")
    prepare(left.sparkSession)
    one = [df.select(F.lit(k).alias("side"), F.col(c).alias("name")).where(F.length(c) > 0).distinct()
           for k, (df, c) in enumerate(((left, left_name), (right, right_name)))]
    names = materialize(one[0].unionAll(one[1]).select("side", F.monotonically_increasing_id().alias("nid"), "name"), "fuzzy-names")
    rows = materialize(prefix_rows(names, threshold), "fuzzy-prefixes")
    key = ["token", "ca", "cb"]
    grid = materialize(rows.groupBy(*key).agg(F.sum(1 - F.col("side")).alias("nl"), F.sum("side").alias("nr")).where("nl > 0 and nr > 0")
                       .select(*key, F.ceil(F.col("nl") / TILE).cast("int").alias("tl"), F.ceil(F.col("nr") / TILE).cast("int").alias("tr")), "fuzzy-grid")

    def dealt(side: int, mine: str, other: str, prefix: str, at: str, across: str) -> DataFrame:
        met = join_small(rows.where(F.col("side") == side), grid, key)
        partner = _shortest(F.col("ca" if side else "cb"))  # a bound that a row has before it meets its partners
        met = met.withColumn("may", F.col("len") - needed(F.col("len"), partner, threshold))
        return met.select(*key, F.pmod(F.xxhash64("nid"), F.col(mine).cast("long")).cast("int").alias(at),
                          F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(across),
                          *[F.col(c).alias(f"{prefix}_{c}") for c in ("nid", "len", "b1", "b2", "may")])

    l, r = dealt(0, "tl", "tr", "l", "i", "j"), dealt(1, "tr", "tl", "r", "j", "i")
    least = needed(F.col("l_len"), F.col("r_len"), threshold)
    lacks = _lacking(("l_b1", "r_b1"), ("l_b2", "r_b2")), _lacking(("r_b1", "l_b1"), ("r_b2", "l_b2"))
    near = ((lacks[0] <= F.col("l_may")) & (lacks[1] <= F.col("r_may"))
            & (lacks[0] <= F.col("l_len") - least) & (lacks[1] <= F.col("r_len") - least))
    on = [l[c] == r[c] for c in (*key, "i", "j")]
    found = l.join(r, [*on, near], "inner").select("l_nid", "r_nid").distinct()  # a pair meets under each of its common rare tokens
    a, b = (names.where(F.col("side") == k).select(F.col("nid").alias(f"{p}_nid"), F.col("name").alias(c))
            for k, p, c in ((0, "l", "left_name"), (1, "r", "right_name")))
    pairs = found.join(a, "l_nid").join(b, "r_nid").select("left_name", "right_name")
    return pairs.withColumn("match_value", match_score(F.col("left_name"), F.col("right_name"), DIGITS)).where(F.col("match_value") >= threshold)


def fuzzy_matches(left: DataFrame, right: DataFrame, left_name: str, right_name: str, right_id: str, threshold: float = 90.0) -> DataFrame:
    """Each row of ``left`` with the right record of the most similar name at or above the
    threshold (equal scores: smallest name, then smallest id), ``match_value``, how many
    different right names reach the threshold, and ``matched`` (score 100)."""
    pairs = fuzzy_pairs(left, right, left_name, right_name, threshold)
    best = materialize(pairs.groupBy(F.col("left_name").alias("_name"))
                       .agg(F.min(F.struct((-F.col("match_value")).alias("s"), F.col("right_name").alias("n"))).alias("b"), F.count(F.lit(1)).alias("n_similar"))
                       .select("_name", F.col("b.n").alias("matched_name"), (-F.col("b.s")).alias("match_value"), "n_similar"), "fuzzy-best")
    ids = right.groupBy(F.col(right_name).alias("matched_name")).agg(F.min(right_id).alias("matched_id"))
    out = join_small(left.withColumn("_name", F.col(left_name)), join_small(ids, best, "matched_name"), "_name", "left").drop("_name")
    return (out.withColumn("n_similar", F.coalesce("n_similar", F.lit(0)))
            .withColumn("matched", F.coalesce(F.col("match_value") == 100.0, F.lit(False))))
