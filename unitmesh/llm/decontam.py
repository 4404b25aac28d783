"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item is cut into windows of ``window`` consecutive words (a shorter item is one
window), and a window is the sequence of its word shingles. For exact containment all
of a window's shingles have to be there, so the necessary prefix is one shingle: the
rarest one.

1. Documents are split into words and written once with a row number.
2. Every document position whose shingle occurs in the benchmark is kept (``hits``):
   a join on the shingle's hash, checked on its words. Nothing else of the corpus is
   needed afterwards.
3. Shingles are ordered by rarity: their number of occurrences over all documents.
4. Each window is found by its rarest shingle only; the place of that shingle in the
   window fixes where the window would start, which has to lie in the document and end
   before the document's last word (positional and length bounds).
5. A candidate is verified exactly: every shingle of the window has to be a hit at its
   place. Covered words are counted once.

The benchmark's tables are broadcast only while their measured rows and bytes are within
``BROADCAST_ROWS`` and ``BROADCAST_BYTES``; beyond that the same joins shuffle, and AQE can
split a hot shingle. A document's words are never shuffled as a whole: its positions carry
their own shingle only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from unitmesh.llm.common import col, ready, written

WINDOW = 10
SHINGLE = 5
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Everything but 0-9, a-z and non-ASCII characters separates words (after lower-casing).
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text):
    """The words of a text column, as an array; null has none."""
    # lower() folds more than A-Z; it is used (being faster) only where there is no more.
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.regexp_extract_all(low, F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def _is_bounded(table: DataFrame) -> bool:
    """Whether a written table's counted rows and bytes are few enough for a broadcast."""
    cells = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) for f in table.schema.fields if f.dataType.simpleString() == "string"), F.lit(16 * len(table.columns)))
    n, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(cells.cast("long")), F.lit(0))).first()
    return n <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def _bounded(table: DataFrame) -> DataFrame:
    """A written table, broadcast if it is small enough."""
    return F.broadcast(table) if _is_bounded(table) else table


def _hash_at(words, position, size: int):
    return F.xxhash64(*[F.get(words, position + k) for k in range(size)])


def _text_at(words, position, size: int):
    return F.concat_ws(" ", F.slice(words, position + 1, size))


def windows_of(items: DataFrame, id_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """(``_item``, ``_wid``, ``_len``, ``_off``, ``_size``, ``_h``, ``_s``): one row for
    each shingle of each distinct window of an item."""
    words = (items.where(col(id_col).isNotNull()).select(col(id_col).alias("_item"), words_of(col(text_col)).alias("_w"))
             .withColumn("_n", F.size("_w")).where("_n > 0"))
    starts = words.withColumn("_len", F.least("_n", F.lit(window))).withColumn(
        "_at", F.explode(F.sequence(F.lit(0), F.col("_n") - F.col("_len"))))
    each = (starts.select("_item", "_len", F.slice("_w", F.col("_at") + 1, F.col("_len")).alias("_w")).distinct()
            .withColumn("_wid", F.sha2(F.concat_ws(" ", "_w"), 256)))
    by_size = []
    for size in range(1, shingle + 1):
        own = each.where(F.col("_len") == size) if size < shingle else each.where(F.col("_len") >= size)
        at = own.withColumn("_off", F.explode(F.sequence(F.lit(0), F.col("_len") - size)))
        by_size.append(at.select("_item", "_wid", "_len", "_off", F.lit(size).alias("_size"),
                                 _hash_at(F.col("_w"), F.col("_off"), size).alias("_h"),
                                 _text_at(F.col("_w"), F.col("_off"), size).alias("_s")))
    out = by_size[0]
    for more in by_size[1:]:
        out = out.unionAll(more)
    return out


def _hits(rows: DataFrame, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """(``_rid``, ``_n``, ``_pos``, ``_s``): document positions whose shingle the benchmark has."""
    found, few = None, _is_bounded(shingles)
    for size in sizes:
        at = rows.where(F.col("_n") >= size).select("_rid", "_n", "_w", F.explode(
            F.sequence(F.lit(0), F.col("_n") - size)).alias("_pos"))
        h, s = _hash_at(F.col("_w"), F.col("_pos"), size), _text_at(F.col("_w"), F.col("_pos"), size)
        own = shingles.where(F.col("_size") == size).select("_h", "_s")
        if few:  # no shuffle: the words are at hand after the join on the hash
            met = (at.withColumn("_h", h).join(F.broadcast(own), "_h").where(s == F.col("_s")))
        else:
            met = at.select("_rid", "_n", "_pos", h.alias("_h"), s.alias("_s")).join(own, ["_h", "_s"])
        met = met.select("_rid", "_n", "_pos", "_s")
        found = met if found is None else found.unionAll(met)
    return found


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(id, ``n_words``, ``n_hit``, ``item_ids``, ``contaminated``, ``text_md5``) for every
    row of ``docs``: its words, those inside any occurrence of any window, the items with
    an occurring window (sorted, as strings), whether any word is hit, and the text's MD5.

    A null text has no words and is clean, and so is an empty one. Items without words
    or without an id take no part; items that repeat an id count as one item with the
    windows of all its rows. Every document row is judged alone, also rows that repeat
    an id. An empty table on either side gives clean rows (or none). Extra columns are
    not read.
    """
    spark = docs.sparkSession
    ready(spark)
    text = col(text_col)
    rows = written(docs.select(
        col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_rid"), F.md5(text.cast("binary")).alias("_md5"),
        words_of(text).alias("_w")).withColumn("_n", F.size("_w")), "decontam-rows")
    windows = written(windows_of(items, item_id, item_text, window, min(shingle, window)), "decontam-windows")
    shingles = written(windows.select("_size", "_h", "_s").distinct(), "decontam-shingles")
    sizes = sorted(r[0] for r in shingles.select("_size").distinct().collect())  # at most ``shingle`` values
    if sizes:
        occurring, of_window = _occurrences(rows, windows, shingles, sizes)
        covered = (occurring.select("_rid", F.explode(F.sequence(F.col("_start"), F.col("_start") + F.col("_len") - 1)).alias("_pos"))
                   .distinct().groupBy("_rid").agg(F.count(F.lit(1)).alias("_hit")))
        which = (occurring.select("_rid", "_wid").distinct().join(_bounded(of_window), "_wid")
                 .select("_rid", F.col("_item").cast("string").alias("_item")).distinct()
                 .groupBy("_rid").agg(F.array_sort(F.collect_list("_item")).alias("_items")))
        rows = rows.drop("_w").join(covered.join(which, "_rid"), "_rid", "left")
    else:
        rows = rows.select("*", F.lit(0).alias("_hit"), F.lit(None).cast("array<string>").alias("_items"))
    hit = F.coalesce("_hit", F.lit(0)).cast("long")
    return rows.select(
        F.col("_id").alias(id_col), F.col("_n").cast("long").alias("n_words"), hit.alias("n_hit"),
        F.coalesce("_items", F.array().cast("array<string>")).alias("item_ids"), (hit > 0).alias("contaminated"),
        F.col("_md5").alias("text_md5"))


def _occurrences(rows: DataFrame, windows: DataFrame, shingles: DataFrame, sizes: list[int]) -> tuple[DataFrame, DataFrame]:
    """(``_rid``, ``_wid``, ``_start``, ``_len``): every place where a window occurs, and
    the items of each window."""
    hits = written(_hits(rows.select("_rid", "_n", "_w"), shingles, sizes), "decontam-hits")
    rarity = written(hits.groupBy("_s").agg(F.count(F.lit(1)).alias("_times")), "decontam-rarity")
    # Windows all of whose shingles occur somewhere, each with its rarest shingle.
    prefix = written(
        windows.join(_bounded(rarity), "_s").groupBy("_wid", "_len", "_size")
        .agg(F.countDistinct("_off").alias("_found"), F.min(F.struct("_times", "_s", "_off")).alias("_first"))
        .where(F.col("_found") == F.col("_len") - F.col("_size") + 1)
        .select("_wid", "_len", "_size", F.col("_first._s").alias("_s"), F.col("_first._off").alias("_off")), "decontam-prefix")
    candidates = (hits.join(_bounded(prefix), "_s")
                  .select("_rid", "_wid", "_len", "_size", "_n", (F.col("_pos") - F.col("_off")).alias("_start"))
                  .where((F.col("_start") >= 0) & (F.col("_start") + F.col("_len") <= F.col("_n"))))
    places = written(windows.select("_wid", "_off", "_s").distinct(), "decontam-places")
    wanted = candidates.join(_bounded(places), "_wid").select(
        "_rid", "_wid", "_len", "_size", "_start", (F.col("_start") + F.col("_off")).alias("_pos"), "_s")
    occurring = written(
        wanted.join(hits.select("_rid", "_pos", "_s"), ["_rid", "_pos", "_s"]).groupBy("_rid", "_wid", "_len", "_size", "_start")
        .agg(F.count(F.lit(1)).alias("_met")).where(F.col("_met") == F.col("_len") - F.col("_size") + 1)
        .select("_rid", "_wid", "_start", "_len"), "decontam-occurring")
    return occurring, written(windows.select("_wid", "_item").distinct(), "decontam-items")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose text has no occurring window, unchanged. Contamination
    depends on the text alone, so rows are dropped by their text's MD5."""
    judged = contamination(docs, items, id_col, text_col, **options)
    bad = written(judged.where("contaminated").select("text_md5").distinct(), "decontam-bad")
    clean = docs.join(_bounded(bad), F.md5(col(text_col).cast("binary")) == bad["text_md5"], "left_anti")
    return clean
