"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three base kinds (assignments, access keys, hex strings) and one wider kind (long
mixed tokens) give candidate values. Their hashes are aggregated over the corpus by
distinct repositories and owners: a value that many owners or many repositories hold
is a copied example, one that a single owner holds in few repositories and that looks
random is a live-looking credential of that owner. Both verdicts come back as further spans; base spans always stay.

Texts are read once and never shuffled; only matches (hash, owner, repository, lengths)
move, dealt by their row, where running sums give their places. A value that a third of the corpus holds is summed before the shuffle, and
the verdicts are joined back from two written tables, so AQE can split a hot hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from unitmesh.llm.common import col, ready, written

# The base kinds in their listed order.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run of at least 24 is a whole run of [0-9a-f]+ that passes
KINDS = ("assign", "access", "hex", "owned", "copied")
FOUND = ("assign", "access", "hex", "wider")  # what the patterns find: the base kinds, then the wider one
MIN_ASSIGNED, MIN_ACCESS = 6, 20
# The wider kind: long tokens of the usual key alphabets.
TOKEN = r"[A-Za-z0-9_+/=-]{20,}"
COPIED_OWNERS, COPIED_REPOS = 3, 10
LIVE_CHARS, LIVE_DISTINCT = 16, 8
# Parts of placeholder values.
PLACEHOLDERS = r"(?i)example|sample|dummy|change_?me|placeholder|your_|xxxx|0000|1234567"


def _found(kind: str, text: Column, found: Column, values: Column, pattern: str) -> Column:
    """array<struct<kind, pos, gap, len, value>> of the matches in ``found``: ``gap`` is the
    length of the text before the match and after the one before it, in code points."""
    between = F.slice(F.split(text, pattern, -1), 1, F.size(found))
    zipped = F.arrays_zip(between.alias("b"), found.alias("m"), values.alias("v"))
    places = F.transform(zipped, lambda x, i: F.struct(
        F.lit(FOUND.index(kind)).alias("kind"), i.alias("pos"), F.char_length(x["b"]).alias("gap"),
        F.char_length(x["m"]).alias("len"), x["v"].alias("value")))
    # a text without matches is not split
    return F.when(F.size(found) > 0, places).otherwise(
        F.array().cast("array<struct<kind:int,pos:int,gap:int,len:int,value:string>>"))


def _matches(text: Column, pattern: str, group: int, needs: Column | None = None) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    return found if needs is None else F.when(needs, found).otherwise(F.array().cast("array<string>"))


def matches_of(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """(``_rid``, ``_id``, ``_owner``, ``_repo``, ``_found``: the matches of every kind) of every row."""
    text = F.col("_text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("_rid"), col(id_col).alias("_id"), col(owner_col).alias("_owner"),
        col(repo_col).alias("_repo"), F.coalesce(col(text_col), F.lit("")).alias("_text"))
    given = text.contains(":") | text.contains("=")
    rows = rows.select("*", _matches(text, ASSIGN, 0, given).alias("_a"),
                       _matches(text, ACCESS, 0, text.contains("AKIA")).alias("_k"),
                       _matches(text, HEX, 0).alias("_h"), _matches(text, TOKEN, 0).alias("_t"))
    rows = rows.select("*", F.when(F.size("_a") > 0, _matches(text, ASSIGN, 2)).otherwise(F.col("_a")).alias("_v"))
    whole = (("access", "_k", ACCESS), ("hex", "_h", HEX), ("wider", "_t", TOKEN))
    return rows.select("_rid", "_id", "_owner", "_repo", F.concat(
        _found("assign", text, F.col("_a"), F.col("_v"), ASSIGN),
        *[_found(kind, text, F.col(c), F.col(c), pattern) for kind, c, pattern in whole]).alias("_found"))


def places_of(rows: DataFrame) -> DataFrame:
    """(``_rid``, ``_owner``, ``_repo``, ``_k``, ``_start``, ``_end``, ``_from``, ``_hash``,
    ``_live``): one row per match that passes its kind's length, its place by a running sum
    of lengths over the text's matches of the kind, so the time is linear in their number. ``_from`` is where
    the value starts. Values are hashed before they move; all later grouping by row reuses
    this one exchange."""
    m = F.col("_m")
    length = F.char_length(m["value"])
    matches = (rows.select("_rid", "_owner", "_repo", F.explode("_found").alias("_m"))
               .select("_rid", "_owner", "_repo", m["kind"].alias("_k"), m["pos"].alias("_pos"),
                       (m["gap"] + m["len"]).alias("_step"), m["len"].alias("_len"), length.alias("_size"),
                       F.md5(m["value"].cast("binary")).alias("_hash"), live_looking(m["value"]).alias("_live"))
               .repartition("_rid"))
    so_far = Window.partitionBy("_rid", "_k").orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    passes = ((F.col("_k") != FOUND.index("assign")) | (F.col("_size") >= MIN_ASSIGNED)) & (
        (F.col("_k") != FOUND.index("access")) | (F.col("_size") >= MIN_ACCESS))
    return (matches.withColumn("_end", F.sum("_step").over(so_far).cast("int")).where(passes)
            .select("_rid", "_owner", "_repo", "_k", (F.col("_end") - F.col("_len")).alias("_start"), "_end",
                    (F.col("_end") - F.col("_size")).alias("_from"), "_hash", "_live"))


def live_looking(value: Column) -> Column:
    """Long, of many different characters, with letters and digits, and no placeholder."""
    return ((F.char_length(value) >= LIVE_CHARS) & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_DISTINCT) & ~value.rlike(PLACEHOLDERS))


def _listed(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", F.get(kinds, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
                 repo_col: str = "doc_id", copied_owners: int = COPIED_OWNERS, copied_repos: int = COPIED_REPOS) -> DataFrame:
    """(id, ``n_assign``, ``n_access``, ``n_hex``, ``n_owned``, ``n_copied``, ``base``,
    ``spans``) for every row; ``base`` and ``spans`` are the base spans and all spans as
    kind:start:end by start, then kind, comma-joined (code points, end exclusive).

    ``copied`` marks a candidate value that at least ``copied_owners`` owners or at least
    ``copied_repos`` repositories hold, ``owned`` one that looks live and that one owner
    alone holds, in fewer repositories; the span is the value's place. A value of several
    owners, but too few of both for a copy, is neither. A value is counted once per
    repository of an owner; a null owner counts as one owner, a null repository as one
    repository.

    A null text is empty and has no spans. Rows that repeat an id keep their own result.
    An empty table gives an empty table. Extra columns are not read.
    """
    ready(docs.sparkSession)
    rows = written(matches_of(docs, id_col, text_col, owner_col, repo_col), "secret-rows")
    places = written(places_of(rows), "secret-places")
    # a place that several kinds find is one candidate
    candidates = written(places.groupBy("_rid", F.col("_from").alias("_start"), "_end").agg(
        F.first("_owner").alias("_owner"), F.first("_repo").alias("_repo"),
        F.first("_hash").alias("_hash"), F.first("_live").alias("_live")), "secret-candidates")
    owners = (candidates.groupBy("_hash", "_owner", "_repo").agg(F.max("_live").alias("_live"))
              .groupBy("_hash", "_owner").agg(F.max("_live").alias("_live"), F.count(F.lit(1)).alias("_repos"))
              .groupBy("_hash").agg(F.max("_live").alias("_live"), F.count(F.lit(1)).alias("_owners"), F.sum("_repos").alias("_repos")))
    copied = (F.col("_owners") >= copied_owners) | (F.col("_repos") >= copied_repos)
    verdict = F.when(copied, F.lit(KINDS.index("copied"))).when(
        (F.col("_owners") == 1) & F.col("_live"), F.lit(KINDS.index("owned")))
    verdicts = written(owners.select("_hash", verdict.alias("_kind")).where("_kind is not null"), "secret-verdicts")
    base = places.where(F.col("_k") < FOUND.index("wider")).select("_rid", "_start", F.col("_k").alias("_kind"), "_end")
    added = candidates.join(verdicts, "_hash").select("_rid", "_start", "_kind", "_end")
    span = F.struct(F.col("_start").alias("start"), F.col("_kind").alias("kind"), F.col("_end").alias("end"))
    of_kind = {k: F.count(F.when(F.col("_kind") == i, 1)) for i, k in enumerate(KINDS)}
    spans = base.unionByName(added).groupBy("_rid").agg(
        *[c.alias(f"n_{k}") for k, c in of_kind.items()],
        F.collect_list(F.when(F.col("_kind") < len(FOUND) - 1, span)).alias("_base"), F.collect_list(span).alias("_all"))
    none = F.lit("")
    return rows.select("_rid", "_id").join(spans, "_rid", "left").select(
        F.col("_id").alias(id_col), *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in KINDS],
        F.coalesce(_listed(F.col("_base")), none).alias("base"), F.coalesce(_listed(F.col("_all")), none).alias("spans"))
