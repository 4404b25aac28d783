"""Deleting sites with everything that hangs on them (DEL1) and re-sequencing the
ordered member lists they leave (DEL2); merge followed by removal (MRG2).

Generalised from one uid per call to a whole request table. Requests for unknown
uids match nothing (the reference still reports success); a site with children is
refused and nothing of it is deleted. Every table is rewritten by one anti-join
against the ids of the deleted sites, broadcast when that id set is proven small; a longer
list of stage instances becomes a bitmap, so their values are not shuffled either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from unitmesh.operators.numbering import row_numbers
from unitmesh.plans.bitmaps import KeyBitmap
from unitmesh.plans.materialize import materialize
from unitmesh.plans.joins import broadcast_if, is_small, join_small, key_values, small_side

# Fixed values of the reference: dependent tables and the column holding the site.
DIRECT_DEPENDENTS = {
    "completedatasetregistration": "sourceid",
    "datavalueaudit": "organisationunitid",
    "datavalue": "sourceid",
    "dataapproval": "organisationunitid",
    "datasetsource": "sourceid",
    "organisationunitattributevalues": "organisationunitid",
    "categoryoption_organisationunits": "organisationunitid",
    "interpretation": "organisationunitid",
    "lockexception": "organisationunitid",
    "minmaxdataelement": "sourceid",
    "orgunitgroupmembers": "organisationunitid",
    "programstageinstance": "organisationunitid",
    "trackedentityinstance": "organisationunitid",
    "userdatavieworgunits": "organisationunitid",
    "program_organisationunits": "organisationunitid",
    "usermembership": "organisationunitid",
    "organisationunittranslations": "organisationunitid",
}
# Deleted through the stage instances of the site.
VIA_STAGE_INSTANCE = ("trackedentitydatavalue", "programstageinstancecomments")
# Ordered member lists and their object column.
MEMBER_LISTS = {
    "chart_organisationunits": "chartid",
    "reporttable_organisationunits": "reporttableid",
    "mapview_organisationunits": "mapviewid",
    "eventchart_organisationunits": "eventchartid",
    "eventreport_organisationunits": "eventreportid",
}

ERR_CHILDREN = "Organisationunit has children. Aborting."  # fixed message of the reference
# Outcome texts of this engine.
STATUS_UNKNOWN = "unknown uid: nothing deleted"
STATUS_DELETED = "deleted"


def validate_deletes(requests: DataFrame, orgunits: DataFrame, requests_small: bool | None = None) -> DataFrame:
    """``requests`` (uid) plus ``organisationunitid`` and ``status`` (JON4 uid lookup,
    AGG9 has-children as a semi-join on parent ids)."""
    small = is_small(requests) if requests_small is None else requests_small
    wanted = broadcast_if(requests.select("uid").distinct(), small)
    units = (orgunits.join(wanted, "uid", "left_semi")
             .groupBy("uid").agg(F.min("organisationunitid").alias("organisationunitid")))
    parents = (orgunits.where(F.col("parentid").isNotNull())
               .join(broadcast_if(units.select(F.col("organisationunitid").alias("parentid")), small),
                     "parentid", "left_semi")
               .select(F.col("parentid").alias("organisationunitid")).distinct()
               .withColumn("has_children", F.lit(True)))
    r = requests.join(units, "uid", "left").join(parents, "organisationunitid", "left")
    status = (F.when(F.col("organisationunitid").isNull(), F.lit(STATUS_UNKNOWN))
              .when(F.col("has_children"), F.lit(ERR_CHILDREN))
              .otherwise(F.lit(STATUS_DELETED)))
    return r.select(*requests.columns, "organisationunitid", status.alias("status"))


def deleted_ids(validated: DataFrame) -> DataFrame:
    return (validated.where(F.col("status") == STATUS_DELETED)
            .select("organisationunitid").distinct())


def resequence(members: DataFrame, object_col: str, ids: DataFrame,
               touched_after_delete: bool = False, ids_small: bool | None = None) -> DataFrame:
    """DEL2 / WIN4 / SRT1 / JON9: remove the members in ``ids`` and renumber the touched
    objects 0..n-1 (the renumbering is the new column, no update-from-join).

    Order: old sort_order, then organisationunitid (the reference leaves equal
    sort_orders in arbitrary order). Objects that lost no member keep their gaps.
    ``touched_after_delete=True`` reproduces the chart list of the reference, whose
    touched objects are looked up after the delete and so are never renumbered.
    """
    key = ids.select("organisationunitid")
    key = broadcast_if(key, is_small(key) if ids_small is None else ids_small)
    remaining = members.join(key, "organisationunitid", "left_anti").select(*members.columns)
    if touched_after_delete:
        return remaining
    touched = materialize(members.join(key, "organisationunitid", "left_semi")
                          .select(object_col).distinct().withColumn("_touched", F.lit(True)), "touched-lists")
    # Written once: kept and renumbered lists read it.
    flagged = materialize(join_small(remaining, touched, object_col, "left"), "flagged-members")
    keep = flagged.where(F.col("_touched").isNull()).drop("_touched")
    redo = row_numbers(flagged.where(F.col("_touched")).drop("_touched"), [object_col],
                       ["sort_order", "organisationunitid"], out="_rn")
    redo = redo.withColumn("sort_order", (F.col("_rn") - 1).cast("int")).drop("_rn")
    return keep.unionByName(redo.select(*members.columns))


class CascadeResult:
    """Outcome of a cascade delete. Tables are built on first access, so asking for
    one table plans (and probes) only what that table needs."""

    def __init__(self, tables: dict[str, DataFrame], requests: DataFrame, ids: DataFrame,
                 chart_literal: bool, object_cols: dict[str, str], requests_small: bool = False):
        self.requests = requests                  # requests with id and status
        self.ids = ids                            # deleted organisationunitid
        self._in = tables
        self._chart_literal = chart_literal
        self._objects = object_cols
        self._out: dict[str, DataFrame] = {}
        self._ids_small: DataFrame | None = None
        # The short key list is read once and becomes a scan filter of every table.
        self._values = key_values(ids, "organisationunitid") if requests_small else None
        self._inst: DataFrame | None = None
        self._inst_bits: KeyBitmap | None = None  # of the instances, if they are many
        self._requests_small = requests_small

    def _small_ids(self) -> DataFrame:
        # deleted ids are a subset of the requested uids: the request probe bounds them
        if self._ids_small is None:
            self._ids_small = broadcast_if(self.ids, self._requests_small)
        return self._ids_small

    def _instances(self) -> DataFrame:
        """Stage instances of the deleted sites (the middle hop)."""
        if self._inst is None:
            if "programstageinstance" not in self._in:
                raise ValueError("programstageinstance is needed to delete its dependents")
            psi = self._scan(self._in["programstageinstance"], "organisationunitid")
            inst = (psi.join(self._small_ids(), "organisationunitid", "left_semi")
                    .select("programstageinstanceid").distinct())
            # Written once: its bytes are known, and every dependent reads it.
            inst = materialize(inst, "delete-instances")
            if not is_small(inst) and isinstance(inst.schema["programstageinstanceid"].dataType, T.IntegralType):
                self._inst_bits = KeyBitmap(inst, "programstageinstanceid")
            self._inst = small_side(inst)
        return self._inst

    def _scan(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` cut to the deleted sites by a filter that reaches the scan, if they are few."""
        return df if self._values is None else df.where(F.col(key).isin(self._values))

    def _keys(self, name: str) -> tuple[str, DataFrame]:
        """(key column of ``name``, DataFrame of deleted keys under that name)."""
        if name in DIRECT_DEPENDENTS or name == "organisationunit":
            key = DIRECT_DEPENDENTS.get(name, "organisationunitid")
            return key, self._small_ids().select(F.col("organisationunitid").alias(key))
        if name in VIA_STAGE_INSTANCE:
            return "programstageinstanceid", self._instances()
        if name in self._objects:
            return "organisationunitid", self._small_ids()
        raise KeyError(name)

    def table(self, name: str) -> DataFrame:
        """``name`` after the delete (unrelated tables come back unchanged)."""
        if name not in self._out:
            df = self._in[name]
            if name in self._objects:
                self._out[name] = resequence(
                    df, self._objects[name], self._small_ids(),
                    touched_after_delete=self._chart_literal and name == "chart_organisationunits",
                    ids_small=self._requests_small)
            else:
                try:
                    key, k = self._keys(name)
                except KeyError:
                    self._out[name] = df
                else:
                    # JON5 (direct key) / JON6 (via stage instances): anti-join delete
                    if name in VIA_STAGE_INSTANCE and self._inst_bits is not None and isinstance(df.schema[key].dataType, T.IntegralType):
                        self._out[name] = self._inst_bits.without(df, key)
                    else:
                        self._out[name] = df.join(k, key, "left_anti").select(*df.columns)
        return self._out[name]

    @property
    def tables(self) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in self._in}

    def counts(self) -> DataFrame:
        """(table_name, deleted_rows) for every given table the delete touches: the tagged
        keys of all tables, joined to the deleted keys once per kind of key and counted."""
        tagged: dict[str, DataFrame] = {}
        names = []
        for name, df in self._in.items():
            try:
                key, _ = self._keys(name)
            except KeyError:
                continue
            names.append((name,))
            kind = "instance" if name in VIA_STAGE_INSTANCE else "site"
            part = (df if kind == "instance" else self._scan(df, key)).select(
                F.lit(name).alias("table_name"), F.col(key).cast("long").alias("k"))
            tagged[kind] = tagged[kind].unionAll(part) if kind in tagged else part
        hits = None
        for kind, rows in tagged.items():
            keys = self._small_ids() if kind == "site" else self._instances()
            if kind == "instance" and self._inst_bits is not None:
                part = self._inst_bits.matching(rows, "k").select("table_name")
            else:
                part = rows.join(keys.select(F.col(keys.columns[0]).cast("long").alias("k")), "k", "left_semi").select("table_name")
            hits = part if hits is None else hits.unionAll(part)
        every = self.requests.sparkSession.createDataFrame(names, "table_name string")
        if hits is None:
            return every.withColumn("deleted_rows", F.lit(0).cast("long"))
        found = hits.groupBy("table_name").agg(F.count(F.lit(1)).alias("deleted_rows"))
        return every.join(found, "table_name", "left").select("table_name", F.coalesce("deleted_rows", F.lit(0)).cast("long").alias("deleted_rows"))


def delete_sites(tables: dict[str, DataFrame], requests: DataFrame, orgunits: DataFrame,
                 chart_literal: bool = True, member_object_cols: dict[str, str] | None = None) -> CascadeResult:
    """Cascade delete of every requested site over the tables that are given.

    ``tables`` maps reference table names to DataFrames; absent tables are skipped.
    ``organisationunit`` (if given) loses the deleted units themselves. Member lists
    are re-sequenced (chart literally: never, see :func:`resequence`).
    """
    small = is_small(requests)
    # Written once: every table's delete and count reads the deleted ids from here
    # instead of re-running the validation in each branch.
    validated = materialize(validate_deletes(requests, orgunits, small), "delete-requests")
    objects = dict(MEMBER_LISTS)
    objects.update(member_object_cols or {})
    ids = materialize(deleted_ids(validated), "delete-ids")
    return CascadeResult(tables, validated, ids, chart_literal, objects, small)


class MergedSites:
    """MRG2 outcome; each table is planned on first access. ``requests`` are the merge
    requests with ids and ``error``; ``merge`` is the value merge (staged, lost, ties)."""

    def __init__(self, tables, dataelement, requests, run_ts, orgunits):
        from unitmesh.operators.merge import merge_map_of, validate_merges

        self._tables = tables
        # Checked first: nothing of a refused request is merged or removed.
        self.requests = materialize(validate_merges(requests, orgunits), "merge-requests")
        self._map = merge_map_of(self.requests)
        sources = self.requests.where(F.col("error").isNull()).select(F.col("source_uid").alias("uid")).distinct()
        rest = {k: v for k, v in tables.items() if k != "datavalue"}
        self.cascade = delete_sites(rest, sources, orgunits)
        self._args = (dataelement, run_ts)
        self._merge = None

    @property
    def merge(self):
        from unitmesh.operators.merge import merge_values

        if self._merge is None:
            dataelement, run_ts = self._args
            self._merge = merge_values(self._tables["datavalue"], dataelement, self._map, None, run_ts)
        return self._merge

    def table(self, name: str) -> DataFrame:
        from unitmesh.operators.merge import replace_sites

        if name != "datavalue":
            return self.cascade.table(name)
        return replace_sites(self._tables["datavalue"], self.merge.staged, self.merge.sites, self.merge.sites_small)


def merge_sites(tables: dict[str, DataFrame], dataelement: DataFrame, requests: DataFrame,
                run_ts: str, orgunits: DataFrame) -> MergedSites:
    """MRG2: validate the merge requests (source_uid, dest_uid, strategy), merge the values
    of every valid pair, then remove each of their source sites with its other dependents
    (which are dropped, not moved to the destination). Refused sources stay whole."""
    return MergedSites(tables, dataelement, requests, run_ts, orgunits)
