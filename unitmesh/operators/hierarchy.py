"""Org-unit hierarchy: paths and levels (SIT5) and their upkeep after changes, interval
labels, descendants (FIL1, SRC7), ancestors.

Paths are computed by pointer doubling: every unit starts with its parent as
"next hop" and the path piece ``/uid``; each round joins the units that have not
arrived to their next hop's row, prepending that row's piece and taking over its next
hop. After k rounds each unit knows 2^k levels, so a tree of depth d needs about
log2(d) rounds of one join each; finished units are not joined or written again. What a
round moves is written to the shared checkpoint folder, which keeps the plan from doubling
in size and lets a lost executor cost only that round.

There is no depth limit. Units that lead into a cycle would double their piece for
ever, so once units are still on their way after a few rounds, those that never arrive
are found first, by the same doubling over ids alone, until there are fewer units on
their way than steps gone. A cycle or a dangling parent gives a NULL path and ``resolved = false``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from unitmesh.operators.numbering import row_numbers
from unitmesh.plans.bitmaps import KeyBitmap
from unitmesh.plans.joins import is_small, join_small, key_values, small_side
from unitmesh.plans.materialize import materialize

# Rounds of path doubling before the units that never arrive are looked for.
ROUNDS_BEFORE_CYCLE_CHECK = 6

# Where a unit's chain ends; NULL while it is on its way.
ROOT, DANGLING = "root", "dangling"


class _State:
    """Units on their way (``end`` NULL) and the written tables of those that have arrived,
    each filtered once, so that a round's plan has one short branch for each table."""

    def __init__(self, live: DataFrame, done: list[DataFrame]):
        self.live, self.done = live, done

    @classmethod
    def of(cls, table: DataFrame, done: list[DataFrame] | None = None) -> _State:
        return cls(table.where(F.col("end").isNull()), [*(done or []), table.where(F.col("end").isNotNull())])

    def frame(self, *columns: Column) -> DataFrame:
        out = self.live.select(*columns) if columns else self.live
        for d in self.done:
            out = out.unionByName(d.select(*columns) if columns else d)
        return out

    def where(self, condition) -> DataFrame:
        return self.frame().where(condition)


def _follow(cur: _State, with_paths: bool) -> _State:
    """One round: units on their way take over their hop's row. Only these are written; they
    meet only the rows that some of them point to."""
    live = cur.live
    n = [F.col("id").alias("hop"), F.col("id").alias("n_id"), F.col("hop").alias("n_hop"), F.col("end").alias("n_end")]
    if with_paths:
        n += [F.col("piece").alias("n_piece"), F.col("depth").alias("n_depth")]
    hops = _pointed_to(cur.frame(*n), live)
    j = live.join(hops, "hop", "left")
    found = F.col("n_id").isNotNull()
    cols = {"hop": F.when(found, F.col("n_hop")).otherwise(F.col("hop")),
            "end": F.when(~found, F.lit(DANGLING)).otherwise(F.col("n_end"))}
    if with_paths:
        cols |= {"piece": F.when(found, F.concat("n_piece", "piece")).otherwise(F.col("piece")),
                 "depth": F.when(found, F.col("depth") + F.col("n_depth")).otherwise(F.col("depth"))}
    moved = j.select(*[cols[c].alias(c) if c in cols else F.col(c) for c in live.columns])
    return _State.of(materialize(moved, "paths" if with_paths else "path-ends"), cur.done)


def _pointed_to(rows: DataFrame, live: DataFrame) -> DataFrame:
    """``rows`` whose ``hop`` some unit of ``live`` points to. Rows hold whole paths, so they
    are told before the shuffle: by a broadcast of the ids or, if many, by their bitmap."""
    ids = live.select("hop").distinct()
    if not is_small(ids) and isinstance(ids.schema["hop"].dataType, T.IntegralType):
        return KeyBitmap(ids, "hop").matching(rows, "hop")
    return rows.join(small_side(ids), "hop", "left_semi")


def _on_their_way(cur: _State) -> bool:
    return not cur.live.isEmpty()


def _never_arriving(cur: _State, steps: int) -> DataFrame:
    """Ids whose chain never ends (they lead into a cycle), of units that have gone
    ``steps`` steps. Without a cycle every further step of a chain leads over another unit
    that is still on its way, so as many steps more as there are such units end it."""
    ids = _State(cur.live.select("id", "hop", "end"), [d.select("id", "hop", "end") for d in cur.done])
    most = None
    while True:
        live = ids.live.count()
        most = steps + live if most is None else min(most, steps + live)
        if not live or steps >= most:
            return ids.live.select("id")
        ids = _follow(ids, False)
        steps *= 2


def _units(orgunits: DataFrame) -> DataFrame:
    """(id, uid, parentid): a repeated id once (its smallest uid), no NULL id."""
    return (orgunits.where(F.col("organisationunitid").isNotNull()).groupBy(F.col("organisationunitid").alias("id"))
            .agg(F.min(F.struct("uid", "parentid")).alias("u")).select("id", "u.uid", "u.parentid"))


def _arrived(units: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Paths of ``units`` (id, uid, parentid). ``known``: rows (as the result's) of other
    units whose paths stand; a chain ends where it meets one of them."""
    cur = units.select(
        "id", "uid", "parentid", F.col("parentid").alias("hop"),
        F.concat(F.lit("/"), F.coalesce("uid", F.lit(""))).alias("piece"), F.lit(1).cast("long").alias("depth"),
        F.when(F.col("parentid").isNull(), F.lit(ROOT)).alias("end"))
    if known is not None:  # a unit below one of them is done; all other chains lead through ``units``
        above = known.select(F.col("organisationunitid").alias("hop"), F.col("path").alias("a_path"), F.col("level").alias("a_level"))
        met = F.col("a_path").isNotNull()
        cur = join_small(cur, above, "hop", "left").select(
            "id", "uid", "parentid", "hop", F.when(met, F.concat("a_path", "piece")).otherwise(F.col("piece")).alias("piece"),
            F.when(met, F.col("depth") + F.col("a_level")).otherwise(F.col("depth")).alias("depth"),
            F.when(met, F.lit(ROOT)).otherwise(F.col("end")).alias("end"))
    cur = _State.of(materialize(cur, "paths"))
    rounds, checked = 0, False
    while _on_their_way(cur):
        if rounds >= ROUNDS_BEFORE_CYCLE_CHECK and not checked:
            lost = _never_arriving(cur, 2 ** rounds).withColumn("_lost", F.lit(True))
            live = materialize(cur.live.join(lost, "id", "left").withColumn("end", F.when(F.col("_lost"), F.lit(DANGLING))).drop("_lost"), "paths")
            cur = _State.of(live, cur.done)
            checked = True
            continue
        cur = _follow(cur, True)
        rounds += 1
    resolved = F.col("end") == ROOT
    return cur.frame().select(F.col("id").alias("organisationunitid"), "uid", "parentid",
                      F.when(resolved, F.col("piece")).alias("path"),
                      F.when(resolved, F.col("depth")).cast("int").alias("level"),
                      resolved.alias("resolved"))


def materialize_paths(orgunits: DataFrame) -> DataFrame:
    """(organisationunitid, uid, parentid, path, level, resolved) for every unit. A
    repeated id counts once (its smallest uid); a NULL id is left out."""
    return _arrived(_units(orgunits))


def path_updates(paths: DataFrame, changed: DataFrame, removed: DataFrame | None = None) -> DataFrame:
    """The rows of ``paths`` (see :func:`materialize_paths`) that change when the units
    ``changed`` (organisationunitid, uid, parentid: added, relocated or renamed) replace
    theirs and the units ``removed`` (organisationunitid) go: new rows, computed anew only
    for the changed units, those below them and those without a path, and a row with
    ``removed`` true for each unit that goes. Work and rows written follow the subtrees
    touched; of the others only the parents met are read into a join.

    A unit's path depends on its chain of ancestors alone. If it had a path, and neither
    the unit nor an ancestor on that path is touched, the chain is the same as before.
    """
    new = materialize(_units(changed), "path-changes")
    gone = removed.select(F.col("organisationunitid").alias("id")).where("id is not null").distinct() if removed is not None else new.select("id").limit(0)
    gone = materialize(gone.join(new.select("id"), "id", "left_anti"), "path-removed")
    touched = new.select("id").unionByName(gone)
    old = paths.withColumnRenamed("organisationunitid", "id")
    marks = materialize(join_small(old, touched, "id", "left_semi").select(F.coalesce("uid", F.lit("")).alias("seg")).distinct(), "path-marks")
    below = join_small(old.where("resolved").select("id", F.explode(F.split(F.expr("substring(path, 2)"), "/")).alias("seg")), marks, "seg", "left_semi")
    again = materialize(below.select("id").unionByName(old.where("not resolved").select("id")).distinct(), "path-below")
    kept = join_small(join_small(old, again, "id", "left_semi").select("id", "uid", "parentid"), touched, "id", "left_anti")
    live = materialize(kept.unionByName(new), "path-again")
    outside = old.where("resolved").join(live.select(F.col("parentid").alias("id")).distinct(), "id", "left_semi")
    outside = outside.join(again.unionByName(touched), "id", "left_anti").withColumnRenamed("id", "organisationunitid")
    out = _arrived(live, outside).withColumn("removed", F.lit(False))
    types = {f.name: f.dataType for f in out.schema.fields}
    drop = join_small(old, gone, "id", "left_semi").select(F.col("id").alias("organisationunitid"), "uid", "parentid", *[
        F.lit(None).cast(types[c]).alias(c) for c in ("path", "level", "resolved")], F.lit(True).alias("removed"))
    return out.unionByName(drop)


def apply_path_updates(paths: DataFrame, updates: DataFrame) -> DataFrame:
    """``paths`` with the rows of :func:`path_updates` in place of theirs."""
    kept = join_small(paths, updates.select("organisationunitid"), "organisationunitid", "left_anti")
    return kept.unionByName(updates.where("not removed").select(*paths.columns))


# Digits of an id in a sort key: fixed width, so that keys sort as their chains do.
_KEY_WIDTH = 16


def interval_labels(orgunits: DataFrame) -> DataFrame:
    """(organisationunitid, uid, parentid, level, ``first``, ``last``) for every unit with a
    path: its place in a walk through the tree (parents before children, children by id)
    and the place of the last unit below it. Its descendants are the units whose ``first``
    is above its ``first`` and at most its ``last``.

    The chain of ids of a unit, each id in digits of one width, is a key; keys below it are
    those it is a prefix of. One sort puts an entry and an exit of every unit (its key, and
    its key with a character above all digits) in walk order; the number of entries before
    an entry or exit is all that is needed. Sorted by ``first``, so written files hold
    ranges and a range filter skips the others.
    """
    units = _units(orgunits)
    chains = materialize_paths(units.select(F.col("id").alias("organisationunitid"),
                                            F.lpad(F.hex(F.col("id").cast("long")), _KEY_WIDTH, "0").alias("uid"), "parentid"))
    keyed = materialize(chains.where("resolved").select(F.col("organisationunitid").alias("id"), F.translate("path", "/", "").alias("key"), "level"), "walk-keys")
    events = keyed.select("id", "key", F.lit(0).alias("exit")).unionByName(keyed.select("id", F.concat("key", F.lit("~")).alias("key"), F.lit(1).alias("exit")))
    # Places among all events; an exit's place less the exits before it is the entries before it.
    placed = row_numbers(events.withColumn("tree", F.lit(0)), ["tree"], ["key", "id", "exit"], out="at").select("id", "exit", "at")
    pairs = placed.groupBy("id").agg(F.max(F.when(F.col("exit") == 0, F.col("at"))).alias("e"), F.max(F.when(F.col("exit") == 1, F.col("at"))).alias("x"))
    # Before the entry of a unit on level l stand, of those that have not left, its l - 1
    # ancestors: entries before it = (events before it + l - 1) / 2. Between its entry and
    # its exit there is an entry and an exit of every unit below it.
    labels = (pairs.join(keyed.select("id", "level"), "id")
              .select("id", "level", ((F.col("e") - 1 + F.col("level") - 1) / 2 + 1).cast("long").alias("first"), ((F.col("x") - F.col("e") - 1) / 2).cast("long").alias("n")))
    out = labels.join(units, "id").select(F.col("id").alias("organisationunitid"), "uid", "parentid", "level", "first", (F.col("first") + F.col("n")).alias("last"))
    return out.repartitionByRange("first").sortWithinPartitions("first")


# Width of the blocks of places by which units meet the intervals that cover them.
LABEL_BLOCK = 4096


def descendants_range(labels: DataFrame, roots: DataFrame) -> DataFrame:
    """FIL1 over written :func:`interval_labels`: (root_uid, uid) for every unit strictly
    below one of ``roots`` (uid). A short list of roots becomes literal ranges that reach
    the scan of the labels; units then meet their roots by blocks of places."""
    found = materialize(join_small(labels, roots.select("uid").distinct(), "uid", "left_semi").select(F.col("uid").alias("root_uid"), F.col("first").alias("lo"), "last"), "label-roots")
    wide = found.where(F.col("last") > F.col("lo"))
    within = labels
    ranges = key_values(wide.select(F.struct("lo", "last").alias("r")), "r", MAX_RANGES)
    if ranges is not None:
        within = labels.where(_any_of(_merged(ranges)))
    covers = wide.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / LABEL_BLOCK), F.floor(F.col("last") / LABEL_BLOCK))))
    units = within.select("uid", "first", F.floor(F.col("first") / LABEL_BLOCK).alias("block"))
    return (join_small(units, covers, "block").where((F.col("first") > F.col("lo")) & (F.col("first") <= F.col("last"))).select("root_uid", "uid"))


# Most intervals written into the filter of a scan.
MAX_RANGES = 200


def _merged(ranges: list) -> list[tuple[int, int]]:
    """Intervals (lo, last] that don't overlap, covering the same places."""
    out: list[tuple[int, int]] = []
    for lo, last in sorted((r[0], r[1]) for r in ranges):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((lo, last))
    return out


def _any_of(ranges: list[tuple[int, int]]) -> Column:
    cond = F.lit(False)
    for k, (lo, last) in enumerate(ranges):
        one = (F.col("first") > lo) & (F.col("first") <= last)
        cond = one if k == 0 else cond | one
    return cond


def ancestor_uids(paths: DataFrame) -> DataFrame:
    """(uid, ancestor_uid, ancestor_level) for every proper ancestor, root = level 1.
    The explode is bounded by the tree depth."""
    segs = F.split(F.expr("substring(path, 2)"), "/")
    return (paths.where(F.col("path").isNotNull())
            .select("uid", F.posexplode(F.slice(segs, 1, F.size(segs) - 1)).alias("pos", "ancestor_uid"))
            .select("uid", "ancestor_uid", (F.col("pos") + 1).cast("int").alias("ancestor_level")))


def descendants(paths: DataFrame, roots: DataFrame) -> DataFrame:
    """FIL1: (root_uid, uid) for every unit strictly below one of ``roots`` (uid)."""
    anc = ancestor_uids(paths)
    r = roots.select(F.col("uid").alias("ancestor_uid")).distinct()
    return join_small(anc, r, "ancestor_uid", "inner").select(F.col("ancestor_uid").alias("root_uid"), "uid")


def with_ancestors(units: DataFrame, paths: DataFrame) -> DataFrame:
    """``units`` (uid, ...) plus ``ancestors`` = array<struct<level,id,code,name>>,
    root first, as the registry export lists them. Each array has at most depth-1
    entries, so collecting them per unit is bounded."""
    anc = ancestor_uids(paths)
    info = units.select(F.col("uid").alias("ancestor_uid"), F.col("code").alias("a_code"), F.col("name").alias("a_name"))
    rows = join_small(anc, info, "ancestor_uid", "left")
    arr = (rows.groupBy("uid")
           .agg(F.array_sort(F.collect_list(F.struct(
               F.col("ancestor_level").alias("level"), F.col("ancestor_uid").alias("id"),
               F.col("a_code").alias("code"), F.col("a_name").alias("name")))).alias("ancestors")))
    out = units.join(arr, "uid", "left")
    return out.withColumn("ancestors", F.coalesce(F.col("ancestors"), F.array().cast(arr.schema["ancestors"].dataType)))

