"""Balanced label propagation: linked documents into the same shard, shards of even size.

Rows with one link value (equal texts) are neighbours of each other. Every row starts in a
shard given by a hash of its content. Then, round by round, the rows of a link that share
a shard look at where most of their neighbours are and ask to move there. Joins bring
these requests together, sums of them for each pair of shards and gain come to the driver
(bounded by shards squared), and capacity quotas decide what part of them is granted, the
highest gains first. What is granted moves, until rounds move next to nothing.

Rows of one link in one shard have the same neighbours and always move together, so the
propagation runs on these parts (at most ``shards`` for a link, however many rows it has)
and meets the rows only once, at the end. A link with more rows than a shard may hold is
dealt beforehand into as many pieces as it must fill shards.

The law is ``rows``: counts at most one apart, exactly. Rows without neighbours cost
nothing to move, so they stand last in their shard, behind those of links that are cut
anyhow; what is beyond a shard's count is dealt, in order, to the shards below theirs. Places come from a range exchange, so no
shard is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from unitmesh.llm.common import col, written
from unitmesh.operators.numbering import row_numbers
from unitmesh.plans.joins import join_small

SHARDS = 16
LAW = "rows"
# The propagation ends once so many rounds in a row have moved less than this share of the
# linked rows: nothing asks to move any more, or the quotas bind.
LEAST_MOVED = 0.001
IDLE_ROUNDS = 2


def _granted(wishes: list[tuple[int, int, int, int]], load: list[int], most: list[int]) -> list[tuple[int, int, int, float]]:
    """Shares granted of the wishes (from, to, gain class, rows): the largest flows between
    shards that keep every load within ``most`` (a shard above it may only shrink), each
    filled from the highest gain down."""
    flow: dict[tuple[int, int], float] = {}
    for a, b, _, n in wishes:
        flow[a, b] = flow.get((a, b), 0) + n
    for _ in range(1000):  # flows only fall: into a shard that would be too full, in proportion
        net = [load[s] + sum(x for (_, b), x in flow.items() if b == s) - sum(x for (a, _), x in flow.items() if a == s) for s in range(len(load))]
        over = {s: net[s] - max(most[s], load[s]) for s in range(len(load)) if net[s] - max(most[s], load[s]) >= 1}
        if not over:
            break
        come = {s: sum(x for (_, b), x in flow.items() if b == s) for s in over}
        flow = {(a, b): x * max(0.0, 1 - over[b] / come[b]) if b in over and come[b] else x for (a, b), x in flow.items()}
    out = []
    for a, b, gain, n in sorted(wishes, key=lambda w: -w[2]):
        take = min(n, flow[a, b])
        flow[a, b] -= take
        if take > 0:
            out.append((a, b, gain, take / n))
    return out


def propagate(parts: DataFrame, most: list[int]) -> DataFrame:
    """``parts`` (``hub``, ``start``, ``n`` rows) plus ``shard``: where the part ends up.
    ``most`` holds the rows that each shard may have."""
    spark = parts.sparkSession
    now = written(parts.withColumn("shard", F.col("start")), "shard-parts")
    idle = number = 0
    while True:
        tally = written(now.groupBy("hub", "shard").agg(F.sum("n").alias("w")), "shard-tally")
        load = {r[0]: r[1] for r in tally.groupBy("shard").agg(F.sum("w")).collect()}  # a row for each shard
        load = [load.get(s, 0) for s in range(len(most))]
        room = [s for s in range(len(most)) if load[s] < most[s]]
        # Where most neighbours are, among the shards with room; equal numbers by a hash.
        best = (tally.where(F.col("shard").isin(room)).groupBy("hub")
                .agg(F.max(F.struct("w", F.xxhash64("hub", "shard").alias("h"), F.col("shard").alias("to"))).alias("b"))
                .select("hub", "b.to", F.floor(F.log2("b.w")).cast("int").alias("gain")))
        wish = written(tally.join(best, "hub").where(F.col("shard") != F.col("to")), "shard-wishes")
        wishes = [tuple(r) for r in wish.groupBy("shard", "to", "gain").agg(F.sum("w")).collect()]  # bounded by shards squared
        if not wishes:
            return now
        number += 1
        shares = spark.createDataFrame(_granted(wishes, load, most), "shard int, to int, gain int, share double")
        go = written(wish.join(F.broadcast(shares), ["shard", "to", "gain"])  # shards squared times classes of gain
                     .where(F.pmod(F.xxhash64("hub", "shard", "to", F.lit(number)), F.lit(1 << 30)) < F.col("share") * (1 << 30)), "shard-moves")
        moved = go.agg(F.coalesce(F.sum("w"), F.lit(0))).first()[0]
        idle = 0 if moved > LEAST_MOVED * sum(load) else idle + 1
        if moved:
            now = written(now.join(go.select("hub", "shard", "to"), ["hub", "shard"], "left").select("hub", "start", "n", F.coalesce("to", "shard").alias("shard")), "shard-parts")
        if idle == IDLE_ROUNDS:
            return now


def _dealt(rows: DataFrame, counts: list[int], quota: list[int]) -> DataFrame:
    """``rows`` (``shard`` and place ``_p`` in it) with what is beyond the quotas moved,
    in order, to the shards below theirs; ``slot`` is the place in the new shard."""
    beyond, starts, open_at = [], [], []
    before = room = 0
    for c, q in zip(counts, quota):
        beyond.append(before - q)
        before += max(0, c - q)
    below = [s for s in range(len(quota)) if counts[s] < quota[s]]
    for s in below:
        starts.append(room)
        open_at.append(counts[s] - room)
        room += quota[s] - counts[s]

    def of(values: list[int], at):
        return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values or [0]]), at)

    own = F.col("shard") + 1
    stays = F.col("_p") < of(quota, own)
    number = F.col("_p") + of(beyond, own)  # among all rows beyond their shard's quota
    target = F.size(F.filter(F.array(*[F.lit(int(v)).cast("long") for v in starts or [0]]), lambda x: x <= F.col("_o")))
    return (rows.withColumn("_stays", stays).withColumn("_o", F.when(~stays, number))
            .withColumn("_to", F.when(~F.col("_stays"), target))
            .withColumn("slot", F.when(F.col("_stays"), F.col("_p")).otherwise(F.col("_o") + of(open_at, F.col("_to"))))
            .withColumn("shard", F.when(F.col("_stays"), F.col("shard")).otherwise(of(below, F.col("_to")).cast("int")))
            .drop("_stays", "_o", "_to", "_p"))


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", link_col: str | None = None,
                    shards: int = SHARDS) -> DataFrame:
    """(id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``) for
    every row: its shard from 0, its place there from 0 without gaps, the UTF-8 bytes of its
    text plus one and their CRC-32. Counts of shards are at most one apart (law ``rows``,
    under which one more shard would move rows among all: ``grown_shard`` is null).

    Linked are rows of equal ``link_col`` (none given: of equal text, null like empty); a
    null link has no neighbours. Rows equal in id and text are placed alike up to the slot.
    The result does not depend on the table's layout. Null ids are ids, an empty table gives
    an empty table, other columns are not read.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit("")).cast("binary")
    link = F.md5(text) if link_col is None else F.md5(col(link_col).cast("string").cast("binary"))
    rows = docs.select(col(id_col).alias("_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
                       F.md5(text).alias("_md5"), link.alias("_link"))
    start = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.col("_md5")), F.lit(shards)).cast("int")
    rows = written(rows.withColumn("_start", start), "shard-rows")
    total = rows.count()
    quota = total // shards + 1
    by_start = written(rows.where(F.col("_link").isNotNull()).groupBy("_link", "_start").agg(F.count(F.lit(1)).alias("n")), "shard-starts")
    linked = written(by_start.groupBy("_link").agg(F.sum("n").alias("m")).where("m > 1"), "shard-links")
    # Pieces of a link that no shard can hold: as many as it must fill, by start.
    pieces = F.least(F.ceil(F.col("m") / quota), F.lit(shards)).cast("int")
    parts = by_start.join(linked, "_link").select(F.struct("_link", F.when(pieces > 1, F.col("_start") % pieces).alias("piece")).alias("hub"),
                                                  F.col("_start").alias("start"), "n")
    at = propagate(parts, [quota] * shards).select(F.col("hub._link").alias("_link"), F.col("start").alias("_start"), F.col("shard").alias("_shard"),
                                                   F.when(F.col("hub.piece").isNull(), 0).otherwise(1).alias("_loose"))
    placed = written(rows.join(at, ["_link", "_start"], "left")
                     .select("_id", "size", "text_crc32", "_link", "_md5", F.coalesce("_shard", "_start").alias("shard"), F.coalesce("_loose", F.lit(2)).alias("_loose")),
                     "shard-placed")
    counts = {r[0]: r[1] for r in placed.groupBy("shard").count().collect()}  # a row for each shard
    counts = [counts.get(s, 0) for s in range(shards)]
    longer = sorted(range(shards), key=lambda s: (-counts[s], s))[:total % shards]  # the odd rows stay where they are
    exact = [total // shards + (s in longer) for s in range(shards)]
    numbered = row_numbers(placed, ["shard"], ["_loose", "_link", "_id", "_md5", "size", "text_crc32"], out="_n").withColumn("_p", F.col("_n") - 1)
    return _dealt(numbered, counts, exact).select(
        F.col("_id").alias(id_col), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
