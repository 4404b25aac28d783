"""Cascade delete (DEL1), re-sequencing (DEL2) and merge-then-remove (MRG2) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitmesh.operators import cascade as C
from unitmesh.plans import fixtures as fx
from unitmesh.plans.bitmaps import KeyBitmap
from unitmesh.plans.q_merge import REQUESTED
from unitmesh.plans.registry import RUN_TS, query

FX = ("f_delete_request", "f_orgunit", "f_datavalue", "f_stage_instance", "f_stage_value", "f_member")

_REQ = """
, units AS (select uid, min(organisationunitid) as organisationunitid from f_orgunit group by uid)
, req AS (select r.uid, u.organisationunitid,
                 case when u.organisationunitid is null then 'unknown uid: nothing deleted'
                      when exists (select 1 from f_orgunit c where c.parentid = u.organisationunitid)
                           then 'Organisationunit has children. Aborting.'
                      else 'deleted' end as status
          from f_delete_request r left join units u on r.uid = u.uid)
, del AS (select distinct organisationunitid from req where status = 'deleted')
, gone_inst AS (select i.programstageinstanceid from f_stage_instance i
                where exists (select 1 from del d where d.organisationunitid = i.organisationunitid))
"""


def _sql(tail: str) -> str:
    return fx.with_clause(list(FX), fx.DUCKDB_TABLES) + _REQ + tail


def _cascade(spark, sf):
    members = fx.load(spark, sf, "f_member")
    tables = {
        "datavalue": fx.load(spark, sf, "f_datavalue"),
        "programstageinstance": fx.load(spark, sf, "f_stage_instance"),
        "trackedentitydatavalue": fx.load(spark, sf, "f_stage_value"),
        "reporttable_organisationunits": members,
        "chart_organisationunits": members,
        "organisationunit": fx.load(spark, sf, "f_orgunit"),
    }
    return C.delete_sites(tables, fx.load(spark, sf, "f_delete_request"), fx.load(spark, sf, "f_orgunit"),
                          member_object_cols={"reporttable_organisationunits": "objectid",
                                              "chart_organisationunits": "objectid"})


@query("delete_validate", _sql("select uid, organisationunitid, status from req"))
def delete_validate(spark, sf):
    """DEL1 checks: every delete request with its unit id and outcome."""
    return _cascade(spark, sf).requests


@query("delete_direct", _sql("""
select dataelementid, periodid, sourceid, categoryoptioncomboid, attributeoptioncomboid, value, storedby, lastupdated,
       comment, followup, created, deleted
from f_datavalue v where not exists (select 1 from del d where d.organisationunitid = v.sourceid)
"""))
def delete_direct(spark, sf):
    """DEL1, direct key: the data value table after deleting the requested sites."""
    return _cascade(spark, sf).table("datavalue")


@query("delete_two_hop", _sql("""
select programstageinstanceid, dataelementid, value from f_stage_value v
where not exists (select 1 from gone_inst g where g.programstageinstanceid = v.programstageinstanceid)
"""))
def delete_two_hop(spark, sf):
    """DEL1, two hops: stage values of the stage instances of deleted sites are removed."""
    return _cascade(spark, sf).table("trackedentitydatavalue")


@query("delete_counts", _sql("""
select 'datavalue' as table_name, count(*) as deleted_rows from f_datavalue v
 where exists (select 1 from del d where d.organisationunitid = v.sourceid)
union all
select 'programstageinstance', count(*) from gone_inst
union all
select 'trackedentitydatavalue', count(*) from f_stage_value v
 where exists (select 1 from gone_inst g where g.programstageinstanceid = v.programstageinstanceid)
union all
select 'reporttable_organisationunits', count(*) from f_member m
 where exists (select 1 from del d where d.organisationunitid = m.organisationunitid)
union all
select 'chart_organisationunits', count(*) from f_member m
 where exists (select 1 from del d where d.organisationunitid = m.organisationunitid)
union all
select 'organisationunit', count(*) from f_orgunit o
 where exists (select 1 from del d where d.organisationunitid = o.organisationunitid)
"""))
def delete_counts(spark, sf):
    """DEL1 summary: rows deleted per table."""
    return _cascade(spark, sf).counts()


@query("resequence", _sql("""
, touched AS (select distinct objectid from f_member m where exists (select 1 from del d where d.organisationunitid = m.organisationunitid))
, remaining AS (select * from f_member m where not exists (select 1 from del d where d.organisationunitid = m.organisationunitid))
select r.objectid, r.organisationunitid,
       case when t.objectid is not null
            then cast(row_number() over (partition by r.objectid order by r.sort_order, r.organisationunitid) - 1 as int)
            else r.sort_order end as sort_order
from remaining r left join touched t on r.objectid = t.objectid
"""))
def resequence(spark, sf):
    """DEL2: member list after the delete; objects that lost a member are renumbered 0..n-1."""
    return _cascade(spark, sf).table("reporttable_organisationunits")


@query("resequence_chart", _sql("""
select objectid, organisationunitid, sort_order from f_member m
where not exists (select 1 from del d where d.organisationunitid = m.organisationunitid)
"""))
def resequence_chart(spark, sf):
    """DEL2 for the chart list as the reference runs it: members removed, never renumbered."""
    return _cascade(spark, sf).table("chart_organisationunits")


def _merged(spark, sf):
    tables = {
        "datavalue": fx.load(spark, sf, "f_datavalue"),
        "programstageinstance": fx.load(spark, sf, "f_stage_instance"),
        "trackedentitydatavalue": fx.load(spark, sf, "f_stage_value"),
        "organisationunit": fx.load(spark, sf, "f_orgunit"),
    }
    return C.merge_sites(tables, fx.load(spark, sf, "f_dataelement"), fx.load(spark, sf, "f_merge_request"),
                         RUN_TS, fx.load(spark, sf, "f_orgunit"))


_MERGED = fx.with_clause(["f_merge_request", "f_orgunit", "f_datavalue", "f_dataelement", "f_stage_instance", "f_stage_value"],
                         fx.DUCKDB_TABLES) + REQUESTED


@query("merge_sites", _MERGED + """
, gone_inst AS (select i.programstageinstanceid from f_stage_instance i
                where exists (select 1 from mm m where m.source_id = i.organisationunitid))
select programstageinstanceid, dataelementid, value from f_stage_value v
where not exists (select 1 from gone_inst g where g.programstageinstanceid = v.programstageinstanceid)
""")
def merge_sites(spark, sf):
    """MRG2: merge requests validated and carried out, the merged sources removed: their
    stage values go too (two hops)."""
    return _merged(spark, sf).table("trackedentitydatavalue")


@query("merge_sites_values", _MERGED + """
select dataelementid, periodid, sourceid, categoryoptioncomboid, value, storedby, lastupdated, comment, followup,
       attributeoptioncomboid, created, deleted
from f_datavalue d where not exists (select 1 from sites s where s.sourceid = d.sourceid)
union all select * from num_agg union all select * from num_rank union all select * from other union all select * from single
""")
def merge_sites_values(spark, sf):
    """MRG2: the value table after the merges; no row of a removed source is left."""
    return _merged(spark, sf).table("datavalue")


@query("merge_sites_units", _MERGED + """
select * from f_orgunit o where not exists (select 1 from mm where mm.source_id = o.organisationunitid)
""")
def merge_sites_units(spark, sf):
    """MRG2: the units after the merges; refused sources (such as those with children) stay."""
    return _merged(spark, sf).table("organisationunit")


def _all_tables(spark, sf):
    """Every dependent table of a site: the value table, stage instances and stage values,
    member lists, and the value table's sites under each other table's key."""
    members = fx.load(spark, sf, "f_member")
    tables = {n: fx.load(spark, sf, "f_stage_instance").select(F.col("organisationunitid").alias(key), "programstageinstanceid")
              for n, key in C.DIRECT_DEPENDENTS.items()}
    tables["datavalue"] = fx.load(spark, sf, "f_datavalue")
    tables |= {n: fx.load(spark, sf, "f_stage_value") for n in C.VIA_STAGE_INSTANCE}
    tables |= {n: members.withColumnRenamed("objectid", key) for n, key in C.MEMBER_LISTS.items()}
    return tables | {"organisationunit": fx.load(spark, sf, "f_orgunit")}


def _count_sql(name: str) -> str:
    if name in C.VIA_STAGE_INSTANCE:
        return (f"select '{name}' as table_name, count(*) as deleted_rows from f_stage_value v "
                "where exists (select 1 from gone_inst g where g.programstageinstanceid = v.programstageinstanceid)")
    table, key = ("f_datavalue", "sourceid") if name == "datavalue" else ("f_member", "organisationunitid") if name in C.MEMBER_LISTS \
        else ("f_orgunit", "organisationunitid") if name == "organisationunit" else ("f_stage_instance", "organisationunitid")
    return (f"select '{name}' as table_name, count(*) as deleted_rows from {table} v "
            f"where exists (select 1 from del d where d.organisationunitid = v.{key})")


@query("delete_counts_all", _sql(" union all ".join(
    _count_sql(n) for n in (*C.DIRECT_DEPENDENTS, *C.VIA_STAGE_INSTANCE, *C.MEMBER_LISTS, "organisationunit"))))
def delete_counts_all(spark, sf):
    """DEL1 summary over all dependent tables of a site (the key list is read once)."""
    return C.delete_sites(_all_tables(spark, sf), fx.load(spark, sf, "f_delete_request"), fx.load(spark, sf, "f_orgunit")).counts()


@query("delete_by_bitmap", fx.oracle("""
, gone AS (select cast(1001 + s_suppkey as int) as sourceid from supplier where s_suppkey % 3 = 0)
select 'left' as part, d.* from f_datavalue d where d.sourceid not in (select sourceid from gone)
union all select 'deleted', d.* from f_datavalue d where d.sourceid in (select sourceid from gone)
""", ["f_datavalue"]))
def delete_by_bitmap(spark, sf):
    """JON2 / JON5: values kept and deleted with every third site, told apart by a bitmap of
    the site ids that the scan probes."""
    dv = fx.load(spark, sf, "f_datavalue")
    gone = fx.raw(spark, sf, "supplier").where("s_suppkey % 3 = 0").select((F.col("s_suppkey") + 1001).cast("int").alias("sourceid"))
    keys = KeyBitmap(gone, "sourceid")
    return (keys.without(dv, "sourceid").select(F.lit("left").alias("part"), "*")
            .unionByName(keys.matching(dv, "sourceid").select(F.lit("deleted").alias("part"), "*")))
