"""Merging duplicate sites: validation (MRG0), value merge (MRG1), swap (SNK1), MRG2.

Semantics follow the reference's merge function, generalised from one
(source, destination) pair per call to any number of pairs in one job. Each source
maps to one destination; several sources may share a destination and are resolved
together.

Rules of the value merge, per destination ``dest`` and value key
``(dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid)``:

* candidates are the rows of the source and destination sites with ``deleted = false``
  (NULL counts as not false); a NULL key matches nothing and the row is lost;
* ``n > 1`` rows with a numeric value type: SUM / AVG / MAX / MIN give one row
  (``storedby = 'admin'``, lastupdated = created = run_ts, comment NULL, followup and
  deleted false); FIRST / LAST keep the earliest / latest rows whole (ties kept,
  identical rows collapsed), NULL lastupdated sorting last ascending and first
  descending;
* ``n > 1`` rows of another value type: the latest row (ties: smallest original
  sourceid), lastupdated = run_ts;
* ``n = 1`` rows of any type move to the destination, lastupdated = run_ts;
* ``n > 1`` rows whose element is unknown or has no value type are lost.

Plan: the hashes of the value keys are counted first, eight bytes a row. A row whose hash
no other row has is alone under its key and moves to its destination in the scan's stage;
only rows of repeated hashes (overlaps, and keys that happen to share a hash) are written
and go on. Where the repeated hashes are too many to broadcast, all rows do.

One partial aggregate per key over these rows carries the count, the
bounds, the numeric aggregate and, for a key of one row, that row itself; it is written
once. Aggregated overlaps and single rows come straight from it, without a join back.
Only overlaps whose winners are rows (FIRST, LAST, other value types) or that are lost
are read again and joined to the written aggregate; both sides of that join are plain
shuffles, so AQE can split a key that holds a large part of all rows. No window is used,
so no key's rows must fit one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from unitmesh.functions.decimals import carried, divided, limbs_text, sum_limbs, to_limbs
from unitmesh.plans.bitmaps import KeyBitmap
from unitmesh.plans.joins import broadcast_if, is_small, join_small, key_values, split_repeated
from unitmesh.plans.materialize import materialize
from unitmesh.schemas import DATAVALUE_COLUMNS, VALUE_KEY

# Fixed values of the reference: the strategies and the numeric value types.
STRATEGIES = ("SUM", "MAX", "MIN", "AVG", "LAST", "FIRST")
NUMERIC_VALUE_TYPES = ("INTEGER", "NUMBER", "INTEGER_ZERO_OR_POSITIVE", "INTEGER_POSITIVE")

# Fixed messages of the reference, in the order the checks run.
ERR_SOURCE = "Invalid source organisation unit"
ERR_DEST = "Invalid destination organisation unit"
ERR_SELF = "Cannot self-merge"
ERR_STRATEGY = "Please provide a merge strategy (SUM,MAX,MIN,AVG,LAST,FIRST)"
ERR_CHILDREN = "Organisationunit has children. Aborting."
# Checks this engine adds for bulk requests.
ERR_REPEATED = "Source is merged more than once"
ERR_CHAIN = "Merge chain: a destination is also a source"
ERR_MIXED = "Destination requested with different strategies"


def _unit_lookup(orgunits: DataFrame, uids: DataFrame, small: bool) -> DataFrame:
    """uid -> (organisationunitid, has_children) for the given uids only (first id
    wins on duplicates). The unit table is cut down to the requested uids by a
    semi-join before anything else, so the lookup stays as small as the request."""
    wanted = broadcast_if(uids.select("uid").distinct(), small)
    units = (orgunits.join(wanted, "uid", "left_semi")
             .groupBy("uid").agg(F.min("organisationunitid").alias("organisationunitid")))
    parents = (orgunits.where(F.col("parentid").isNotNull())
               .join(broadcast_if(units.select(F.col("organisationunitid").alias("parentid")), small),
                     "parentid", "left_semi")
               .select(F.col("parentid").alias("organisationunitid")).distinct()
               .withColumn("has_children", F.lit(True)))
    return (units.join(parents, "organisationunitid", "left")
            .select("uid", "organisationunitid", F.coalesce("has_children", F.lit(False)).alias("has_children")))


def validate_merges(requests: DataFrame, orgunits: DataFrame, in_order: bool = False) -> DataFrame:
    """Add ``source_id``, ``dest_id`` and ``error`` (NULL when valid) to merge requests.

    ``requests`` has ``source_uid``, ``dest_uid``, ``strategy``. Checks, first failure
    reported: unknown source, unknown destination, self-merge, strategy not one of the
    six (case-sensitive), source has children, source requested more than once, a
    chain (the destination is some request's source, or the source some request's
    destination), and a destination requested with different strategies. With
    ``in_order`` the requests are to be replayed one after another
    (:mod:`unitmesh.operators.replay`), where the last three are no errors.
    """
    uids = (requests.select(F.col("source_uid").alias("uid"))
            .unionByName(requests.select(F.col("dest_uid").alias("uid"))))
    lookup = _unit_lookup(orgunits, uids, is_small(uids))
    src = lookup.select(F.col("uid").alias("source_uid"), F.col("organisationunitid").alias("source_id"),
                        F.col("has_children").alias("source_has_children"))
    dst = lookup.select(F.col("uid").alias("dest_uid"), F.col("organisationunitid").alias("dest_id"))
    # One aggregate over every uid's roles: uses as source, uses as destination and the
    # strategies it is requested with as a destination.
    roles = (requests.select(F.col("source_uid").alias("uid"), F.lit(1).alias("as_src"), F.lit(0).alias("as_dst"),
                             F.lit(None).cast("string").alias("dst_strategy"))
             .unionByName(requests.select(F.col("dest_uid").alias("uid"), F.lit(0).alias("as_src"),
                                          F.lit(1).alias("as_dst"), F.col("strategy").alias("dst_strategy")))
             .groupBy("uid").agg(F.sum("as_src").alias("n_src"), F.sum("as_dst").alias("n_dst"),
                                 F.countDistinct("dst_strategy").alias("n_strat")))
    as_src_uid = roles.select(F.col("uid").alias("source_uid"), F.col("n_src").alias("source_uses"),
                              (F.col("n_dst") > 0).alias("source_is_dest"))
    as_dst_uid = roles.select(F.col("uid").alias("dest_uid"), (F.col("n_src") > 0).alias("dest_is_source"),
                              F.col("n_strat").alias("dest_strategies"))
    r = (requests
         .join(src, "source_uid", "left")
         .join(dst, "dest_uid", "left")
         .join(as_src_uid, "source_uid", "left")
         .join(as_dst_uid, "dest_uid", "left"))
    # SCL11: the checks as one CASE, first failure wins
    error = (F.when(F.col("source_id").isNull(), F.lit(ERR_SOURCE))
             .when(F.col("dest_id").isNull(), F.lit(ERR_DEST))
             .when(F.col("source_uid") == F.col("dest_uid"), F.lit(ERR_SELF))
             .when(~F.coalesce(F.col("strategy").isin(*STRATEGIES), F.lit(False)), F.lit(ERR_STRATEGY))
             .when(F.col("source_has_children"), F.lit(ERR_CHILDREN)))
    if not in_order:
        chained = F.coalesce(F.col("dest_is_source"), F.lit(False)) | F.coalesce(F.col("source_is_dest"), F.lit(False))
        error = (error.when(F.col("source_uses") > 1, F.lit(ERR_REPEATED))
                 .when(chained, F.lit(ERR_CHAIN))
                 .when(F.col("dest_strategies") > 1, F.lit(ERR_MIXED)))
    return r.select(*requests.columns, "source_id", "dest_id", error.alias("error"))


def merge_map_of(validated: DataFrame) -> DataFrame:
    """The (source_id, dest_id, strategy) of the requests that passed validation."""
    return validated.where(F.col("error").isNull()).select("source_id", "dest_id", "strategy")


def element_classes(dataelement: DataFrame) -> DataFrame:
    """dataelementid -> is_numeric / is_other. A NULL value type is in neither class."""
    vt = F.col("valuetype")
    return dataelement.groupBy("dataelementid").agg(
        F.max(F.coalesce(vt.isin(*NUMERIC_VALUE_TYPES), F.lit(False))).alias("is_numeric"),
        F.max(F.coalesce(~vt.isin(*NUMERIC_VALUE_TYPES), F.lit(False))).alias("is_other"))


def merge_sites_of(merge_map: DataFrame) -> DataFrame:
    """Every site touched by the map (sources and destinations) with its destination."""
    return (merge_map.select(F.col("source_id").alias("sourceid"), F.col("dest_id").alias("dest"))
            .unionByName(merge_map.select(F.col("dest_id").alias("sourceid"), F.col("dest_id").alias("dest")))
            .distinct())


@dataclass
class MergeResult:
    staged: DataFrame   # rows that replace all rows of the touched sites
    lost: DataFrame     # live rows that the rules drop (NULL key, untyped overlaps)
    sites: DataFrame    # (sourceid, dest) of every touched site
    ties: DataFrame     # FIRST/LAST keys whose winning rows differ (all kept in staged)
    sites_small: bool = False  # the touched-site list is within the broadcast bound


def _winner_first(ts: Column) -> Column:
    # ORDER BY lastupdated ASC with NULLs last: the minimum; all NULL -> all tie.
    return F.when(F.col("min_ts").isNull(), ts.isNull()).otherwise(ts == F.col("min_ts"))


def _winner_last(ts: Column) -> Column:
    # ORDER BY lastupdated DESC with NULLs first: any NULL wins, else the maximum.
    return F.when(F.col("has_null_ts"), ts.isNull()).otherwise(ts == F.col("max_ts"))


AGG_STRATEGIES = ("SUM", "AVG", "MAX", "MIN")


def merge_values(datavalue: DataFrame, dataelement: DataFrame, merge_map: DataFrame,
                 strategy: str | None, run_ts: str, cast_mode: str = "ansi") -> MergeResult:
    """Merge the values of every (source_id, dest_id) pair of ``merge_map``.

    ``strategy`` applies to every pair; with ``strategy=None`` the map's ``strategy``
    column decides per destination (the validation rejects a destination requested
    with different strategies; unvalidated, the alphabetically first one applies).
    ``run_ts`` stands for the reference's ``now()`` so results are reproducible.
    Non-numeric text in an aggregated overlap fails the job; ``cast_mode='try'`` leaves
    it out instead. Text in a key of one row is moved as it is. Numbers are exact to 72
    digits before and 36 after the point, AVG is rounded half away from zero to 10 digits
    after it; a number of more digits in an aggregated overlap fails the job in both modes.
    None of this depends on the session's ANSI setting.
    """
    if strategy is not None and strategy not in STRATEGIES:
        raise ValueError(ERR_STRATEGY)
    if cast_mode not in ("ansi", "try"):
        raise ValueError(f"unknown cast mode {cast_mode!r}")
    now = F.lit(run_ts).cast("timestamp_ntz")
    sites = merge_sites_of(merge_map)
    if strategy is None:
        per_dest = merge_map.groupBy(F.col("dest_id").alias("dest")).agg(F.min("strategy").alias("strat"))
        sites = sites.join(per_dest, "dest")
        used = AGG_STRATEGIES
    else:
        sites = sites.withColumn("strat", F.lit(strategy))
        used = (strategy,) if strategy in AGG_STRATEGIES else ()
    # Written once: every branch reads the touched sites from here, and their bytes are known.
    sites = materialize(sites, "merge-sites")
    classes = element_classes(dataelement)
    # A short site list becomes a scan filter.
    site_ids = key_values(sites, "sourceid")
    sites_small = is_small(sites)

    # JON2/JON4: rows of the touched sites with their destination id (broadcast when small)
    scan = datavalue if site_ids is None else datavalue.where(F.col("sourceid").isin(site_ids))
    involved = scan.join(broadcast_if(sites, sites_small), "sourceid", "inner")
    # FIL11: live rows only; NULL deleted is not false
    live = involved.where(F.col("deleted") == F.lit(False))
    key_ok = F.lit(True)
    for k in VALUE_KEY:
        key_ok = key_ok & F.col(k).isNotNull()
    null_key = live.where(~key_ok)
    group = ["dest"] + VALUE_KEY
    keyed, alone = split_repeated(live.where(key_ok), F.xxhash64(*group))
    # FIL10/JON3: numeric vs other value types (a NULL type is neither)
    keyed = join_small(keyed, classes, "dataelementid", "left")
    ts = F.col("lastupdated")
    strat = F.col("strat")
    is_num = F.coalesce(F.col("is_numeric"), F.lit(False))
    is_oth = F.coalesce(F.col("is_other"), F.lit(False))
    aggregated = is_num & F.coalesce(strat.isin(*AGG_STRATEGIES), F.lit(False))

    # AGG1/AGG2: key counts (n > 1 overlaps, n = 1 singletons); AGG3/AGG4/AGG5/AGG6: SUM/AVG/MAX/MIN;
    # AGG7/WIN1/WIN2/WIN3: the FIRST/LAST/latest bounds, used instead of rank() windows.
    # SCL9: numbers exact to 72 digits before and 36 after the point, whatever the strategy
    keyed = keyed.withColumn("number", F.when(aggregated, to_limbs(F.col("value"))))
    limbs, state = F.col("number.limbs"), F.col("number.state")
    aggs = [F.count(F.lit(1)).alias("n"),
            F.max(ts.isNull()).alias("has_null_ts"),
            F.max(ts).alias("max_ts"),
            F.min(ts).alias("min_ts"),
            F.max(aggregated).alias("key_aggregated"),
            F.min(F.when(state == "text", F.col("value"))).alias("bad_value"),
            F.min(F.when(state == "long", F.col("value"))).alias("long_value"),
            # the row itself where there is one; the smallest costs nothing more
            F.min(F.struct(*DATAVALUE_COLUMNS)).alias("row")]
    if used:
        aggs += [F.max(strat).alias("strat"), F.count(limbs).alias("numbers")]
        if {"SUM", "AVG"} & set(used):
            mine = F.when(strat.isin("SUM", "AVG"), limbs)
            aggs.append(F.array(*sum_limbs(mine)).alias("total"))
        # signed limbs, highest first, compare as the numbers do
        aggs += [fn(F.when(strat == name, limbs)).alias(name) for name, fn in (("MAX", F.max), ("MIN", F.min)) if name in used]
    per_key = materialize(keyed.groupBy(*group).agg(*aggs), "merge-keys")
    keyed = keyed.drop("number")

    def out(df: DataFrame, row: str = "", **over: Column) -> DataFrame:
        cols = [over.get(c, F.col("dest").alias("sourceid") if c == "sourceid" else F.col(row + c)).alias(c)
                for c in DATAVALUE_COLUMNS]
        return df.select(*cols)

    multi = F.col("n") > 1
    parts = []
    if used:
        wide = lambda c: carried(F.transform(c, lambda x: x.cast("decimal(38,0)")))
        of = {"SUM": lambda: carried(F.col("total")), "AVG": lambda: divided(carried(F.col("total")), F.col("numbers")),
              "MAX": lambda: wide(F.col("MAX")), "MIN": lambda: wide(F.col("MIN"))}
        text = None
        for name in used:
            value = F.when(F.col("numbers") > 0, limbs_text(of[name]()))
            text = F.when(F.col("strat") == name, value) if text is None else text.when(F.col("strat") == name, value)
        text = F.when(F.col("long_value").isNotNull(), F.raise_error(
            F.concat(F.lit("more digits than 72 before or 36 after the point: "), F.col("long_value"))).cast("string")).otherwise(text)
        if cast_mode == "ansi":
            text = F.when(F.col("bad_value").isNotNull(), F.raise_error(
                F.concat(F.lit("not a number: "), F.col("bad_value"))).cast("string")).otherwise(text)
        parts.append(out(per_key.where(multi & F.col("key_aggregated")), "row.",
                         value=text, storedby=F.lit("admin"),
                         lastupdated=now, comment=F.lit(None).cast("string"), followup=F.lit(False),
                         created=now, deleted=F.lit(False)))
    # Overlaps that end as rows: read again and joined to the written aggregate.
    bounds = per_key.where(multi).select(*group, "n", "has_null_ts", "max_ts", "min_ts")
    rows = materialize(keyed.where(~aggregated | is_oth).join(bounds, group), "merge-overlaps")
    ties = None
    if strategy is None or strategy in ("FIRST", "LAST"):
        win = (((strat == "FIRST") & _winner_first(ts)) | ((strat == "LAST") & _winner_last(ts)))
        winners = out(rows.where(is_num & win)).dropDuplicates()
        parts.append(winners)
        ties = (winners.groupBy(F.col("sourceid").alias("dest"), *VALUE_KEY)
                .agg(F.count(F.lit(1)).alias("winners")).where(F.col("winners") > 1))

    # Other value types: latest row; on equal lastupdated the smallest original sourceid.
    cand = rows.where(is_oth & _winner_last(ts))
    best_src = materialize(cand.groupBy(*group).agg(F.min("sourceid").alias("best_src")), "merge-latest")
    parts.append(out(cand.join(best_src, group).where(F.col("sourceid") == F.col("best_src")),
                     lastupdated=now))

    parts.append(out(per_key.where(F.col("n") == 1), "row.", lastupdated=now))
    if alone is not None:
        parts.append(out(alone, lastupdated=now))
    # SET1: the branches are one bag union (UNION ALL); AGG10: DISTINCT only in FIRST/LAST.
    staged = parts[0]
    for p in parts[1:]:
        staged = staged.unionByName(p)

    lost = (rows.where(~is_num & ~is_oth)
            .select(*DATAVALUE_COLUMNS, "dest", F.lit("no value type").alias("reason"))
            .unionByName(null_key.select(*DATAVALUE_COLUMNS, "dest", F.lit("null key").alias("reason"))))
    if strategy is None:
        # numeric overlaps of a destination without a valid strategy (unvalidated map)
        lost = lost.unionByName(
            rows.where(is_num & ~F.coalesce(strat.isin(*STRATEGIES), F.lit(False)))
            .select(*DATAVALUE_COLUMNS, "dest", F.lit("no strategy").alias("reason")))
    if ties is None:
        ties = staged.sparkSession.createDataFrame(
            [], "dest int, dataelementid int, periodid int, categoryoptioncomboid int, "
                "attributeoptioncomboid int, winners bigint")
    return MergeResult(staged=staged, lost=lost, sites=sites.select("sourceid", "dest"), ties=ties,
                       sites_small=sites_small)


def replace_sites(base: DataFrame, staged: DataFrame, sites: DataFrame, sites_small: bool | None = None) -> DataFrame:
    """All rows of the touched sites (tombstones included) replaced by ``staged``.

    A broadcast anti-join when the site list is small, a bitmap of the ids beyond that, so
    the rewrite of the base table is a single map-only pass.
    """
    ids = sites.select("sourceid").distinct()
    if is_small(ids) if sites_small is None else sites_small:
        kept = base.join(F.broadcast(ids), "sourceid", "left_anti")
    else:  # a long list: a bitmap of the ids keeps the base table out of a shuffle
        kept = KeyBitmap(ids, "sourceid").without(base, "sourceid")
    return kept.unionByName(staged.select(*base.columns))
