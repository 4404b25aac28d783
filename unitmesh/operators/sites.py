"""Bulk site directives: split (SIT1), validated adds (SIT2), edits (SIT3) and
relocations (SIT4), applying them to a snapshot (SNK3) and a file/snapshot diff (JON10).

The reference walks the directive file row by row and scans the site list for every
check. Here each check is a join against the snapshot, so a file of any length is
validated in a few shuffles. Declared differences from the row loop:

* all checks look at the snapshot as read (the loop mutates it as it goes);
* for edits, a code counts as taken if it is in the snapshot or claimed by an
  earlier accepted edit; a rejected row leaves no trace. With ``in_order`` a code is
  taken while a site holds it, as in the loop: an earlier accepted edit that gives its
  site another code frees the old one (:func:`codes_in_order`);
* edits and relocations of one site give one final state (the last non-blank value
  per field over its accepted rows, by row number) that both batches show.

Directive columns: row_no, op, uid, name, parent_uid, new_name, lat, lon, shortname,
code and, optionally, parent_code. Snapshot columns: id, name, shortName, code,
parent_id, openingDate, featureType, coordinates, created and, optionally, row_no
(the order that decides "first match" on duplicate codes or names).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from unitmesh.operators.numbering import row_numbers, running_sums
from unitmesh.plans.joins import broadcast_if, is_small, join_small
from unitmesh.plans.materialize import materialize

# Fixed values of the reference.
ADD_OPS = ("add",)
EDIT_OPS = ("edit", "update", "rename")
RELOCATE_OPS = ("relocate",)
DEFAULT_OPENING_DATE = "1970-01-01"
SHORT_NAME_LENGTH = 50

# Reject reasons, codes of this engine, in check order.
R_UID = "uid_missing"
R_NAME = "name_missing"
R_PARENT_MISSING = "parent_missing"
R_PARENT_CODE = "parent_code_unknown"
R_PARENT_UID = "parent_uid_unknown"
R_EXISTS = "site_exists"
R_REPEATED = "uid_repeated"
R_SITE = "site_unknown"
R_CODE = "code_taken"
R_UNKNOWN_OP = "operation_unknown"


def _blank(c: Column) -> Column:
    # SCL8: a missing value counts as ''
    return F.coalesce(c, F.lit("")) == ""


def split_directives(directives: DataFrame) -> DataFrame:
    """SIT1: ``kind`` = add / edit / relocate / unknown from the lower-cased operation."""
    op = F.lower(F.coalesce(F.col("op"), F.lit("")))  # SCL2
    kind = (F.when(op.isin(*ADD_OPS), "add").when(op.isin(*EDIT_OPS), "edit")
            .when(op.isin(*RELOCATE_OPS), "relocate").otherwise("unknown"))
    return directives.withColumn("kind", kind)


def _key(column: str) -> Column:
    """A join key that blank cells share with nothing: each gets a value of its own, so
    the many blank rows neither match nor meet in one partition."""
    return F.when(_blank(F.col(column)), F.concat(F.lit("\u0000"), F.col("row_no").cast("string"))).otherwise(F.col(column))


def _looked_up(d: DataFrame, column: str, table: DataFrame, small: bool) -> DataFrame:
    """``d`` left joined to ``table`` (first column: the key) on a column that may be blank."""
    key = table.columns[0]
    return (d.withColumn("_key", _key(column))
            .join(broadcast_if(table.withColumnRenamed(key, "_key"), small), "_key", "left").drop("_key"))


def _order(snapshot: DataFrame) -> Column:
    return F.col("row_no") if "row_no" in snapshot.columns else F.col("id")


def _ids(snapshot: DataFrame, alias: str, flag: str) -> DataFrame:
    return snapshot.select(F.col("id").alias(alias)).distinct().withColumn(flag, F.lit(True))


def site_adds(directives: DataFrame, snapshot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SIT2: (payload of accepted adds, rejects with reason)."""
    d = split_directives(directives).where(F.col("kind") == "add")
    if "parent_code" not in d.columns:
        d = d.withColumn("parent_code", F.lit(""))
    ordcol = _order(snapshot)
    snap_small = is_small(snapshot)  # one probe bounds every lookup below (all derive from it)
    # FIL5 / SRT3: parent id from code, first match by snapshot order (min_by)
    by_code = (snapshot.where(F.col("code").isNotNull())
               .groupBy(F.col("code").alias("_code"))
               .agg(F.min_by("id", ordcol).alias("code_parent")))
    known = _ids(snapshot, "parent_uid", "parent_known")  # FIL3: uid exists
    d = _looked_up(_looked_up(d, "parent_code", by_code, snap_small), "parent_uid", known, snap_small)
    resolved = F.when(_blank(F.col("parent_uid")), F.col("code_parent")).otherwise(F.col("parent_uid"))
    d = d.withColumn("resolved_parent", resolved).withColumn("name_q", F.replace(F.col("name"), F.lit("'"), F.lit("''")))
    # FIL6 / SCL4: existing site by (name with ' doubled, parent)
    existing = (snapshot.where(F.col("parent_id").isNotNull())
                .groupBy(F.col("name").alias("name_q"), F.col("parent_id").alias("resolved_parent"))
                .agg(F.min_by("id", ordcol).alias("existing_id")))
    d = d.join(broadcast_if(existing, snap_small), ["name_q", "resolved_parent"], "left")
    reason = (F.when(_blank(F.col("uid")), R_UID)
              .when(_blank(F.col("name")), R_NAME)
              .when(_blank(F.col("parent_uid")) & _blank(F.col("parent_code")), R_PARENT_MISSING)
              .when(_blank(F.col("parent_uid")) & F.col("code_parent").isNull(), R_PARENT_CODE)
              .when(~_blank(F.col("parent_uid")) & F.col("parent_known").isNull(), R_PARENT_UID)
              .when(F.col("existing_id").isNotNull(), R_EXISTS))
    # Written once: payload and rejects both read the checked rows. Of accepted rows that
    # repeat a uid the first one stands.
    d = materialize(d.withColumn("reason", reason), "site-adds")
    first = materialize(d.where(F.col("reason").isNull()).groupBy("uid").agg(F.min("row_no").alias("first_row")), "site-add-uids")
    d = d.join(first, "uid", "left").withColumn("reason", F.when(
        F.col("reason").isNull() & (F.col("row_no") != F.col("first_row")), F.lit(R_REPEATED)).otherwise(F.col("reason")))
    point = ~_blank(F.col("lon")) & ~_blank(F.col("lat"))
    # PRJ12 add payload: SCL3 first 50 characters, SCL6 "[lon,lat]", SCL10 fixed opening date
    payload = d.where(F.col("reason").isNull()).select(
        "row_no",
        F.col("uid").alias("id"),
        "name",
        F.when(_blank(F.col("shortname")), F.substring("name", 1, SHORT_NAME_LENGTH))
         .otherwise(F.col("shortname")).alias("shortName"),
        F.coalesce(F.col("code"), F.lit("")).alias("code"),
        F.col("resolved_parent").alias("parent_id"),
        F.lit(DEFAULT_OPENING_DATE).alias("openingDate"),
        F.when(point, F.lit("POINT")).alias("featureType"),
        F.when(point, F.format_string("[%s,%s]", F.col("lon"), F.col("lat"))).alias("coordinates"))
    rejects = d.where(F.col("reason").isNotNull()).select("row_no", "op", "uid", "reason")
    return payload, rejects


@dataclass
class SiteUpdates:
    state: DataFrame       # final state of every site with an accepted edit or relocation
    edits: DataFrame       # the edit batch (sites with an accepted edit)
    relocates: DataFrame   # the relocation batch (sites with an accepted relocation)
    rejects: DataFrame     # (row_no, op, uid, reason)


def _last(cond: Column, value: Column) -> Column:
    """Value of the last row (by row_no) where ``cond`` holds; NULL if none."""
    return F.max(F.when(cond, F.struct(F.col("row_no").alias("r"), value.alias("v")))).getField("v")


def codes_in_order(claims: DataFrame, held: DataFrame) -> DataFrame:
    """Which claims (``row_no`` unique, ``uid``, ``code``) a loop over the rows would grant
    when a code is free unless a site holds it at that moment; ``held`` (uid, code) holds
    the codes at first. Returns (``row_no``, ``granted``).

    A claim depends on earlier ones alone: on those of its code, and on those by which
    holders of its code take another. So all claims are judged at once on the verdicts of
    the round before, and this is repeated until no verdict changes; then every verdict
    follows from those before it, as in the loop, and no other set of verdicts does. A
    verdict is right after as many rounds as its chain of dependencies has steps.

    A round is joins and sums: each granted claim starts a hold of its code and ends its
    site's previous one; a claim fails if more holds of its code have started than ended
    before it. Previous codes are met by numbers within sites and holds are summed over a
    range exchange, so neither a site nor a code with a third of all rows is one task.
    """
    first = materialize(held.where(F.col("code").isNotNull()).select("uid", "code").distinct(), "code-holds")
    now = materialize(claims.select("row_no", "uid", "code").withColumn("granted", F.lit(True)), "code-claims")
    while True:
        granted = row_numbers(now.where("granted").select("row_no", "uid", "code"), ["uid"], ["row_no"], out="n")
        granted = materialize(granted, "code-granted")
        after = granted.select("uid", (F.col("n") - 1).alias("n"), F.col("row_no").alias("end_row"))
        later_end = granted.join(after, ["uid", "n"]).select("code", F.col("end_row").alias("row_no"))
        first_end = join_small(first, granted.where("n = 1").select("uid", "row_no"), "uid").select("code", "row_no")
        event = lambda df, value: df.select("code", "row_no", F.lit(value).alias("change"), F.lit(0).alias("claim"), F.lit(None).cast("boolean").alias("granted"))
        events = (event(first.select("code", F.lit(None).cast("long").alias("row_no")), 1).unionByName(event(granted, 1))
                  .unionByName(event(later_end, -1)).unionByName(event(first_end, -1))
                  .unionByName(now.select("code", "row_no", F.lit(0).alias("change"), F.lit(-1).alias("claim"), "granted")))
        # Holds at first have no row and sort first; a claim sorts before what it causes itself.
        judged = running_sums(events, ["code"], ["row_no", "claim", "change"], "change", "holders").where("claim = -1")
        new = materialize(judged.select("row_no", "code", (F.col("holders") == 0).alias("granted"), F.col("granted").alias("was")), "code-judged")
        if new.where(F.col("granted") != F.col("was")).isEmpty():
            return new.select("row_no", "granted")
        now = materialize(now.select("row_no", "uid").join(new.select("row_no", "code", "granted"), "row_no"), "code-claims")


def site_updates(directives: DataFrame, snapshot: DataFrame, today: str, in_order: bool = False) -> SiteUpdates:
    """SIT3 + SIT4: validated edits and relocations, folded into one state per site.
    ``in_order``: codes are free or taken as they would be at their row of the file."""
    d = split_directives(directives).where(F.col("kind").isin("edit", "relocate"))
    snap_small = is_small(snapshot)  # one probe bounds every lookup below (all derive from it)
    sites = _ids(snapshot, "uid", "site_known")
    parents = _ids(snapshot, "parent_uid", "parent_known")
    taken = (snapshot.where(F.col("code").isNotNull()).select("code").distinct()
             .withColumn("code_taken", F.lit(True)))
    d = _looked_up(d, "uid", sites, snap_small)
    d = _looked_up(_looked_up(d, "parent_uid", parents, snap_small), "code", taken, snap_small)
    is_edit = F.col("kind") == "edit"
    pre = (F.when(F.col("site_known").isNull(), R_SITE)
           .when(is_edit & ~_blank(F.col("parent_uid")) & F.col("parent_known").isNull(), R_PARENT_UID)
           .when(~is_edit & F.col("parent_known").isNull(), R_PARENT_UID)
           .when(is_edit & ~_blank(F.col("code")) & F.col("code_taken").isNotNull() & F.lit(not in_order), R_CODE))
    d = d.withColumn("reason", pre)
    # A new code goes to the first otherwise-valid edit that claims it.
    d = materialize(d, "site-checked")
    claims = d.where(F.col("reason").isNull() & is_edit & ~_blank(F.col("code")))
    if in_order:
        held = snapshot.groupBy(F.col("id").alias("uid")).agg(F.min_by("code", _order(snapshot)).alias("code"))
        verdicts = codes_in_order(claims, held).select("row_no", F.when(F.col("granted"), F.col("row_no")).otherwise(-1).alias("claim_row"))
        d = d.join(verdicts, "row_no", "left")
    else:
        claims = materialize(claims.groupBy("code").agg(F.min("row_no").alias("claim_row")), "site-claims")
        d = _looked_up(d, "code", claims, False)
    d = d.withColumn("reason", F.when(F.col("reason").isNull() & is_edit & ~_blank(F.col("code"))
                                      & (F.col("row_no") != F.col("claim_row")), F.lit(R_CODE))
                     .otherwise(F.col("reason")))
    # Written once: the state fold, both batches and the rejects read the checked rows.
    d = materialize(d.drop("claim_row"), "site-updates")
    ok = d.where(F.col("reason").isNull())
    named = is_edit & ~_blank(F.col("new_name"))
    point = is_edit & ~_blank(F.col("lat")) & ~_blank(F.col("lon"))
    moved = ~_blank(F.col("parent_uid"))
    coded = is_edit & ~_blank(F.col("code"))
    short = F.substring(F.when(_blank(F.col("shortname")), F.col("new_name")).otherwise(F.col("shortname")),
                        1, SHORT_NAME_LENGTH)
    # PRJ13 / SCL12: last non-blank value per field (FIL4 the current row supplies the rest)
    changes = ok.groupBy("uid").agg(
        _last(named, F.col("new_name")).alias("new_name"),
        _last(named, short).alias("new_short"),
        _last(point, F.format_string("[%s, %s]", F.col("lon"), F.col("lat"))).alias("new_coordinates"),
        _last(moved, F.col("parent_uid")).alias("new_parent"),
        _last(coded, F.col("code")).alias("new_code"),
        F.max(is_edit).alias("has_edit"),
        F.max(~is_edit).alias("has_relocate"))
    # One snapshot row per id (the first by order on duplicates), only for changed sites.
    ordcol = _order(snapshot)
    # changed sites are snapshot ids, so the snapshot's bound holds for them too
    snap = (snapshot.join(broadcast_if(changes.select(F.col("uid").alias("id")), snap_small), "id", "left_semi")
            .groupBy(F.col("id").alias("uid"))
            .agg(*[F.min_by(c, ordcol).alias(c) for c in snapshot.columns if c not in ("id", "row_no")]))
    s = changes.join(snap, "uid", "left")
    state = s.select(
        F.col("uid").alias("id"),
        F.coalesce("new_name", "name").alias("name"),
        F.coalesce("new_short", "shortName").alias("shortName"),
        F.coalesce("new_code", "code", F.lit("")).alias("code"),
        F.coalesce("new_parent", "parent_id").alias("parent_id"),
        F.col("openingDate"),
        F.when(F.col("new_coordinates").isNotNull(), F.lit("POINT")).otherwise(F.col("featureType")).alias("featureType"),
        F.coalesce("new_coordinates", "coordinates", F.lit("")).alias("coordinates"),
        F.when(F.col("has_relocate"), F.coalesce("created", F.lit(""))).otherwise(F.col("created")).alias("created"),
        F.lit(today).alias("lastUpdated"),
        # every other field of the site goes along unchanged: an import would erase it
        *[c for c in snap.columns if c not in (
            "uid", "name", "shortName", "code", "parent_id", "openingDate", "featureType", "coordinates", "created", "lastUpdated")],
        "has_edit", "has_relocate")
    cols = [c for c in state.columns if c not in ("has_edit", "has_relocate")]
    rejects = d.where(F.col("reason").isNotNull()).select("row_no", "op", "uid", "reason")
    return SiteUpdates(state=state.select(*cols, "has_edit", "has_relocate"),
                       edits=state.where("has_edit").select(*cols),
                       relocates=state.where("has_relocate").select(*cols),
                       rejects=rejects)


def all_rejects(directives: DataFrame, add_rejects: DataFrame, updates: SiteUpdates) -> DataFrame:
    """Every directive that is not carried out, with its reason (unknown ops included),
    from the results of :func:`site_adds` and :func:`site_updates`."""
    unknown = (split_directives(directives).where(F.col("kind") == "unknown")
               .select("row_no", "op", "uid", F.lit(R_UNKNOWN_OP).alias("reason")))
    return add_rejects.unionByName(updates.rejects).unionByName(unknown)


def apply_updates(snapshot: DataFrame, updates: DataFrame, adds: DataFrame | None = None) -> DataFrame:
    """SNK3: import with strategy UPDATE / merge mode MERGE: non-NULL fields of an update
    overwrite the stored ones; unknown ids are ignored. ``adds`` (if given) are created."""
    cols = [c for c in snapshot.columns if c != "row_no"]
    upd = updates.select(*[F.col(c).alias(f"u_{c}") for c in cols if c in updates.columns])
    j = snapshot.join(upd, snapshot["id"] == upd["u_id"], "left")
    out = j.select(*[(F.coalesce(F.col(f"u_{c}"), F.col(c)) if c in updates.columns and c != "id" else F.col(c)).alias(c)
                     for c in cols])
    if adds is not None:
        new = adds.join(snapshot.select("id"), "id", "left_anti")
        out = out.unionByName(new.select(*[F.col(c) if c in new.columns else F.lit(None).cast(snapshot.schema[c].dataType).alias(c)
                                           for c in cols]))
    return out


def site_diff(directives: DataFrame, snapshot: DataFrame) -> DataFrame:
    """JON10: per uid, the file's latest add/edit against the snapshot:
    added (file only), missing (snapshot only), changed (name differs), same."""
    d = split_directives(directives).where(F.col("kind").isin("add", "edit"))
    proposed = F.when(F.col("kind") == "add", F.col("name")).otherwise(F.col("new_name"))
    latest = (d.groupBy("uid")
              .agg(F.max(F.struct(F.col("row_no").alias("r"), proposed.alias("v"))).getField("v").alias("file_name"))
              .withColumn("in_file", F.lit(True)))
    snap = snapshot.select(F.col("id").alias("uid"), F.col("name").alias("site_name")).withColumn("in_snapshot", F.lit(True))
    j = latest.join(snap, "uid", "full_outer")
    status = (F.when(F.col("in_snapshot").isNull(), "added")
              .when(F.col("in_file").isNull(), "missing")
              .when(~_blank(F.col("file_name")) & (F.col("file_name") != F.coalesce(F.col("site_name"), F.lit(""))), "changed")
              .otherwise("same"))
    return j.select("uid", status.alias("status"), "file_name", "site_name")


def batch_counts(adds: DataFrame, edits: DataFrame, relocates: DataFrame) -> DataFrame:
    """AGG11: sizes of the three bulk batches in one row (one aggregate job)."""
    tagged = (adds.select(F.lit("add").alias("b"))
              .unionByName(edits.select(F.lit("edit").alias("b")))
              .unionByName(relocates.select(F.lit("relocate").alias("b"))))
    return tagged.agg(*[F.count(F.when(F.col("b") == k, 1)).alias(f"{k}_count") for k in ("add", "edit", "relocate")])


def country_sites(snapshot: DataFrame, country_uid: str) -> DataFrame:
    """SRC7 / FIL1: the snapshot rows strictly below ``country_uid`` (the site list the
    directives are checked against), found through the hierarchy of id / parent_id."""
    from unitmesh.operators.hierarchy import descendants, materialize_paths

    units = snapshot.select(F.col("id").alias("organisationunitid"), F.col("id").alias("uid"),
                            F.col("parent_id").alias("parentid"))
    below = descendants(materialize_paths(units),
                        snapshot.sparkSession.createDataFrame([(country_uid,)], "uid string"))
    return snapshot.join(below.select(F.col("uid").alias("id")), "id", "left_semi")
