"""Merkle dataset manifest with proofs by pointer jumping.

Every row is a leaf. The leaves of a group (in order of their key) form a tree of runs of
``arity`` nodes; the groups' subroots, in the order of the groups, form the top tree whose
last node is the root. A tree is built a level at a time, each level a written table of
runs, a sixteenth as long as the one below.

Proofs come from pointer jumping. A node above the leaves holds a pointer to an ancestor
(at first the node its run is hashed to) and the sibling segments on the way there: what
stands to its left and right in each run. Each round joins the nodes that have not reached
the root with the nodes they point to, appends these nodes' segments and takes over their
pointers, so the distance doubles; a tree of depth d needs about log2(d) rounds. The
leaves of one run share all segments but their place in that run, so the run holds them
once and its leaves take them over at the end, in a join of one row with one row.

Everything is DataFrame functions. Digests are lowercase hex where they are hashed and
bytes where they are stored. No group is collected: places within groups come from a range
exchange, a run holds at most ``arity`` nodes, and pointers that many nodes share meet a
written table of the nodes pointed to (broadcast only within the byte bound, otherwise a
join of plain scans whose hot keys AQE splits).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from unitmesh.llm.common import col, packed, unpacked, written
from unitmesh.operators.numbering import row_numbers
from unitmesh.plans.joins import join_small

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # number of the top tree
_BYTES = 32


def digest(*parts: Column) -> Column:
    """H: lowercase hex SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_of(fields, replaced: dict[str, Column] | None = None) -> Column:
    """A row's leaf: H of its fields, each ``-`` if null, else its UTF-8 byte count, ``:``
    and its value. ``replaced`` gives other values for some fields."""
    def part(name: str) -> Column:
        value = (replaced or {}).get(name, col(name)).cast("string")
        return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))
    return digest(*[part(f) for f in fields])


def _hex(bytes_: Column) -> Column:
    return F.lower(F.hex(bytes_))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) and its siblings give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(_hex(s["left"]), h, _hex(s["right"])).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """H of all siblings on the way up, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(_hex(s["left"]), _hex(s["right"]))), "").cast("binary"), 256)


def _segment(place: Column, run: Column) -> Column:
    """What stands left and right of a place (from 0) in a run's bytes."""
    at = place.cast("int") * _BYTES
    return F.struct(F.substring(run, F.lit(1), at).alias("left"),
                    F.substring(run, at + _BYTES + 1, F.octet_length(run)).alias("right"))


def _runs_of(nodes: DataFrame, arity: int) -> DataFrame:
    """(t, n, r, members, run): runs of consecutive nodes (t, n, i, d) of a tree's level."""
    runs = (nodes.groupBy("t", "n", F.floor(F.col("i") / arity).alias("r"))
            .agg(F.array_sort(F.collect_list(F.struct("i", "d"))).alias("members")))
    return runs.withColumn("run", F.unhex(F.array_join(F.transform("members", lambda m: F.hex(m["d"])), "")))


def _key(tree: Column, level: int, place: Column) -> Column:
    return F.struct(tree.cast("long").alias("t"), F.lit(level).alias("l"), place.cast("long").alias("i"))


def _above(level: int, arity: int, is_top: bool, single: bool) -> Column:
    """Key of the node that a run is hashed to; null for the root."""
    last = F.col("n") <= arity
    if is_top:
        return F.when(~last, _key(F.col("t"), level + 1, F.col("r")))
    subroot = F.lit(None) if single else _key(F.lit(TOP), 0, F.col("t"))
    return F.when(last, subroot).otherwise(_key(F.col("t"), level + 1, F.col("r")))


def _tree(nodes: DataFrame, level: int, most: int, arity: int, is_top: bool, single: bool) -> tuple[list, list]:
    """Builds levels from ``nodes`` (t, n, i, d) up while a tree of it has several nodes
    (``most``: of the largest tree). Returns the nodes with pointer and first segment, and
    the last nodes of the trees, a table for each level."""
    held, last = [], [nodes.where("n = 1")]
    while most > 1:
        runs = written(_runs_of(nodes.where("n > 1"), arity), "merkle-runs")
        own = F.col("d") if is_top and level == 0 else F.lit(None).cast("binary")
        held.append(runs.select(_above(level, arity, is_top, single).alias("a"), "t", "run", F.explode("members").alias("m"))
                    .select(_key(F.col("t"), level, F.col("m.i")).alias("k"), "a",
                            F.array(_segment(F.col("m.i") % arity, F.col("run"))).alias("path"),
                            F.col("m.d").alias("d")).withColumn("subroot", own).drop("d"))
        nodes = runs.select("t", F.ceil(F.col("n") / arity).alias("n"), F.col("r").alias("i"), F.unhex(digest(_hex(F.col("run")))).alias("d"))
        level, most = level + 1, -(-most // arity)
        last.append(nodes.where("n = 1"))
    return held, last


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _jump(nodes: DataFrame) -> list[DataFrame]:
    """Paths to the root for all nodes (k, a, path, subroot), in written tables. A node
    that has reached the root is not written again."""
    now = written(nodes, "merkle-nodes")
    done = []
    while True:
        done.append(now.where(F.col("a").isNull()))
        live = now.where(F.col("a").isNotNull())
        if live.isEmpty():
            return done
        everything = _union([*done, live]).select(F.col("k").alias("a"), F.col("a").alias("next"), F.col("path").alias("more"), F.col("subroot").alias("sub"))
        hops = written(everything.join(live.select("a").distinct(), "a", "left_semi"), "merkle-hops")
        now = written(join_small(live, hops, "a").select(
            "k", F.col("next").alias("a"), F.concat("path", "more").alias("path"), F.coalesce("subroot", "sub").alias("subroot")), "merkle-nodes")


def proofs(leaves: DataFrame, leaf_col: str, key_col: str, group_col: str, arity: int = ARITY) -> DataFrame:
    """``leaves`` plus ``subroot`` and ``root`` (hex) and ``path``, the siblings (left and
    right of the row's node, as bytes) from the leaf up to the root.

    ``leaf_col`` holds hex digests. Leaves of a group are ordered by key (null first), rows
    that repeat a key by leaf; rows equal in both are interchangeable and each a leaf of its
    own. A null group is a group, the first; groups are ordered by their UTF-8 bytes. A lone
    leaf is its group's subroot, a lone subroot the root (then the path is empty). An empty
    table gives an empty table. A column of ``leaves`` named like a result is replaced.
    """
    parts = {"_key": key_col, "_group": group_col, "_leaf": leaf_col}
    rows = written(packed(leaves, parts).withColumn("_leaf", F.unhex("_leaf")), "merkle-leaves")
    numbered = row_numbers(rows, ["_group"], ["_key", "_leaf"], out="_n").withColumn("_i", F.col("_n") - 1).drop("_n")
    low = written(numbered.groupBy("_group", F.floor(F.col("_i") / arity).alias("r"))
                  .agg(F.array_sort(F.collect_list(F.struct("_i", "_leaf", *[c for c in rows.columns if c not in ("_group", "_leaf")]))).alias("members")),
                  "merkle-low")
    groups = low.groupBy("_group").agg(F.sum(F.size("members").cast("long")).alias("n"))
    trees = written(row_numbers(written(groups.withColumn("_all", F.lit(0)), "merkle-groups"), ["_all"], ["_group"], out="_t")
                    .select(F.col("_group").alias("_g"), "n", (F.col("_t") - 1).alias("t")), "merkle-trees")
    n_trees, most = trees.agg(F.count(F.lit(1)), F.max("n")).first()
    single = n_trees <= 1
    run = F.unhex(F.array_join(F.transform("members", lambda m: F.hex(m["_leaf"])), ""))
    low = written(join_small(low, trees, F.col("_group").eqNullSafe(F.col("_g"))).drop("_g").withColumn("run", run), "merkle-low")
    # A lone leaf is a subroot already; every other run of leaves is hashed to a node of level 1.
    first = low.select("t", F.when(F.col("n") == 1, 1).otherwise(F.ceil(F.col("n") / arity)).alias("n"), F.col("r").alias("i"),
                       F.when(F.col("n") == 1, F.col("run")).otherwise(F.unhex(digest(_hex(F.col("run"))))).alias("d"))
    held, last = _tree(first, 1, -(-(most or 0) // arity), arity, False, single)
    subroots = written(_union(last).select(F.lit(TOP).alias("t"), F.lit(n_trees).alias("n"), F.col("t").alias("i"), "d"), "merkle-subroots")
    top_held, top = _tree(subroots, 0, n_trees, arity, True, single)
    root = _union(top).select(_hex(F.col("d"))).first()
    root = root[0] if root else None
    held += top_held
    at = F.when(F.col("n") > 1, _above(0, arity, False, single)).otherwise(F.lit(None) if single else _key(F.lit(TOP), 0, F.col("t")))
    low = low.withColumn("k", at)
    if held:
        low = low.join(_union(_jump(_union(held))), "k", "left")
    else:
        low = low.withColumn("path", F.expr("cast(array() as array<struct<left: binary, right: binary>>)")).withColumn("subroot", F.lit(None).cast("binary"))
    none = F.expr("cast(array() as array<struct<left: binary, right: binary>>)")
    each = low.select("_group", "n", "run", "path", "subroot", F.explode("members").alias("m"))
    own = F.when(F.col("n") > 1, F.array(_segment(F.col("m._i") % arity, F.col("run")))).otherwise(none)
    out = each.select("_group", *[F.col(f"m.{c}").alias(c) for c in rows.columns if c != "_group"],
                      F.concat(own, F.coalesce("path", none)).alias("_path"),
                      F.coalesce(_hex(F.col("subroot")), F.lit(root)).alias("_subroot"), F.lit(root).cast("string").alias("_root"))
    return unpacked(out.withColumn("_leaf", _hex(F.col("_leaf"))), leaves, parts, {"subroot": "_subroot", "root": "_root", "path": "_path"})


def manifest(table: DataFrame, tampered: dict[str, Column] | None = None, when: Column | None = None,
             fields=FIELDS, key_col: str = "doc_id", group_col: str = "source", arity: int = ARITY) -> DataFrame:
    """(key, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``)
    for every row: the manifest of ``table``, checked against a copy of it in which rows
    where ``when`` holds have the ``tampered`` field values (none: the table itself).

    A row is verified if the leaf of the copy and the siblings of the table give the root.
    Null fields count as stated in :func:`leaf_of`; a null ``when`` counts as false. Other
    columns are not read. Order, ties and empty tables: see :func:`proofs`.
    """
    copy = leaf_of(fields, tampered)
    changed = F.coalesce(when if when is not None else F.lit(bool(tampered)), F.lit(False))
    leaves = table.select(col(key_col).alias("key"), col(group_col).alias("group"), leaf_of(fields).alias("leaf"),
                          F.when(changed, F.unhex(copy)).alias("copy") if tampered else F.lit(None).cast("binary").alias("copy"))
    p = proofs(leaves, "leaf", "key", "group", arity)
    folded = fold(F.coalesce(_hex(F.col("copy")), F.col("leaf")), F.col("path"))
    return (p.select(F.col("key").alias(key_col), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
