"""Registry (REG1, PRJ5-11), terminology (PRJ10, JON7, SET2, SRC4) and format mapping
(PRJ1-4, JON8, FIL2) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitmesh.operators import hierarchy as H
from unitmesh.operators import mapping as MP
from unitmesh.operators import registry as R
from unitmesh.operators.numbering import row_numbers
from unitmesh.plans import fixtures as fx
from unitmesh.session import scratch_path
from unitmesh.plans.registry import query
from unitmesh.sources.responses import from_headers_rows

HOST = "https://hmis.local"

_TREE = """
, tree AS (select organisationunitid, uid, '/' || uid as path, 1 as level, []::INTEGER[] as anc from f_orgunit where parentid is null
           union all
           select c.organisationunitid, c.uid, t.path || '/' || c.uid, t.level + 1, list_append(t.anc, t.organisationunitid)
           from f_orgunit c join tree t on c.parentid = t.organisationunitid )
, anc AS (select t.uid, a.uid as a_uid, a.code as a_code, a.name as a_name, x.lvl
          from (select uid, unnest(anc) as aid, generate_subscripts(anc, 1) as lvl from tree) x
          join tree t on t.uid = x.uid join f_orgunit a on a.organisationunitid = x.aid)
"""


def _rec(names: list[str]) -> str:
    return fx.with_clause(names, fx.DUCKDB_TABLES, recursive=True) + _TREE


def unit_paths(spark, sf):
    """Stand-in for the stored unit paths (the source system keeps a path per unit):
    computed once per session with the SIT5 operator and read as a table."""
    def build():
        ou = fx.load(spark, sf, "f_orgunit")
        return H.materialize_paths(ou.select("organisationunitid", "uid", "parentid"))
    return fx.load_built(spark, sf, "unit_paths", build)


def nested_units(spark, sf):
    """Stand-in for the registry export: org units with ``ancestors`` and
    ``organisationUnitGroups`` arrays (ancestors from the stored paths, groups from
    f_unit_group), built once per session."""
    return fx.load_built(spark, sf, "nested_units", lambda: _nested_units(spark, sf))


def _nested_units(spark, sf):
    ou = fx.load(spark, sf, "f_orgunit")
    units = H.with_ancestors(ou.select("uid", "code", "name"), unit_paths(spark, sf))
    g = fx.load(spark, sf, "f_unit_group")
    groups = g.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct(
        F.col("group_id").alias("id"), F.col("group_code").alias("code"), F.col("group_name").alias("name"),
        F.array().cast("array<struct<id:string,code:string,name:string>>").alias("groupSets")))).alias("organisationUnitGroups"))
    out = units.join(groups, "uid", "left")
    return out.select(F.col("uid").alias("id"), "code", "name", F.lit("1970-01-01").alias("openingDate"),
                      F.lit(None).cast("string").alias("closedDate"), "ancestors",
                      F.coalesce("organisationUnitGroups", F.array().cast(groups.schema["organisationUnitGroups"].dataType))
                      .alias("organisationUnitGroups"))


def _facility(spark, sf):
    return R.to_facility(nested_units(spark, sf))


_SYSID = """substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21, 12)"""


@query("facility", _rec(["f_orgunit", "f_unit_group"]) + f"""
, g AS (select uid, count(*) as n_groups from f_unit_group group by uid)
select o.uid as id, {_SYSID} as systemid, o.name, o.code,
       cast(t.level - 1 as int) as n_admin_units, cast(1 + coalesce(g.n_groups, 0) as int) as n_authority,
       t.level = 1 as empty_ancestors_kept, g.uid is null as empty_groups_kept
from (select *, sha256('facility:' || uid) as h from f_orgunit) o
join tree t on t.uid = o.uid left join g on g.uid = o.uid
""")
def facility(spark, sf):
    """REG1: one facility record per unit (summary: system id, sizes, empty lists passed through)."""
    f = _facility(spark, sf)
    return f.select("id", "systemid", "name", "code",
                    F.size("administrativeUnits").cast("int").alias("n_admin_units"),
                    F.size("authority").cast("int").alias("n_authority"),
                    F.col("ancestors").isNotNull().alias("empty_ancestors_kept"),
                    F.col("organisationUnitGroups").isNotNull().alias("empty_groups_kept"))


@query("facility_units", _rec(["f_orgunit"]) + """
select uid as id, cast(lvl - 1 as int) as unit_pos, cast(lvl as int) as level, cast(0 as int) as ident_pos,
       'id' as ident_type, a_uid as ident_value from anc
union all
select uid, cast(lvl - 1 as int), cast(lvl as int), cast(1 as int), 'code', a_code from anc where a_code is not null
union all
select uid, cast(lvl - 1 as int), cast(lvl as int), cast(case when a_code is null then 1 else 2 end as int), 'name', a_name
from anc where a_name is not null
""")
def facility_units(spark, sf):
    """PRJ6: administrativeUnits of every facility, one row per identifier of each level."""
    f = _facility(spark, sf)
    u = f.select("id", F.posexplode("administrativeUnits").alias("unit_pos", "u"))
    i = u.select("id", "unit_pos", F.col("u.value").alias("level"), F.posexplode("u.identifier").alias("ident_pos", "x"))
    return i.select("id", F.col("unit_pos").cast("int"), F.col("level").cast("int"), F.col("ident_pos").cast("int"),
                    F.col("x.type").alias("ident_type"), F.col("x.value").alias("ident_value"))


@query("facility_authority", _rec(["f_orgunit", "f_unit_group"]) + """
, g AS (select *, row_number() over (partition by uid order by group_id, group_code, group_name) as pos from f_unit_group)
select uid as id, cast(0 as int) as pos, 'ownership' as type, '' as value, cast(null as varchar) as system,
       cast(null as int) as ident_pos, cast(null as varchar) as ident_type, cast(null as varchar) as ident_value
from f_orgunit
union all
select uid, cast(pos as int), group_name, 'Yes', 'DHIS2', cast(0 as int), 'id', group_id from g
union all
select uid, cast(pos as int), group_name, 'Yes', 'DHIS2', cast(1 as int), 'code', group_code from g where group_code is not null
""")
def facility_authority(spark, sf):
    """PRJ7: authority entries (ownership first, then one 'Yes' entry per group with its identifiers)."""
    f = _facility(spark, sf)
    a = f.select("id", F.posexplode("authority").alias("pos", "a"))
    i = a.select("id", "pos", F.col("a.type").alias("type"), F.col("a.value").alias("value"),
                 F.col("a.system").alias("system"), F.posexplode_outer("a.identifier").alias("ident_pos", "x"))
    return i.select("id", F.col("pos").cast("int"), "type", "value", "system", F.col("ident_pos").cast("int"),
                    F.col("x.type").alias("ident_type"), F.col("x.value").alias("ident_value"))


@query("admin_report", _rec(["f_orgunit"]) + """
select max(case when a.lvl = 1 then a.a_name end) as Admin_1_name, max(case when a.lvl = 2 then a.a_name end) as Admin_2_name,
       max(case when a.lvl = 3 then a.a_name end) as Admin_3_name, max(case when a.lvl = 4 then a.a_name end) as Admin_4_name,
       o.name, o.uid as id
from f_orgunit o left join anc a on a.uid = o.uid group by o.uid, o.name
""")
def admin_report(spark, sf):
    """PRJ11: Admin_1..4_name (ancestor names by level), name, id for every unit."""
    return R.admin_report(nested_units(spark, sf))


@query("warehouse_rename", fx.oracle("""
select orgUnit as location, dataElement, period, categoryOptionCombo as disaggregation, attributeOptionCombo as attribution,
       value, storedby, comment, followup from f_payload
""", ["f_payload"]))
def warehouse_rename(spark, sf):
    """PRJ1: dataValues in warehouse names (orgUnit, attributeOptionCombo, categoryOptionCombo renamed)."""
    return MP.to_warehouse(fx.load(spark, sf, "f_payload"))


@query("rename_back", fx.oracle("select * from f_payload", ["f_payload"]))
def rename_back(spark, sf):
    """PRJ2: warehouse records back to reporting names (location, id, attribution, disaggregation)."""
    return MP.from_warehouse(fx.load(spark, sf, "f_warehouse"))


@query("fields", fx.oracle("select id, name, code, valueType, formName from f_element_meta", ["f_element_meta"]))
def fields(spark, sf):
    """PRJ3: default field list of dataElements."""
    return MP.select_fields(fx.load(spark, sf, "f_element_meta"), "dataElements")


@query("identifiers", fx.oracle(f"""
select row_no, cast(0 as int) as pos, id as value, 'id' as property, '{HOST}/api/dataElements/' || id as system, 'dhis2' as type
from f_element_meta where id is not null
union all
select row_no, cast(1 as int), name, 'name', '{HOST}/api/dataElements/' || id || '?fields=id,name&filter=name:eq:' || name, 'dhis2'
from f_element_meta where id is not null and name is not null
union all
select row_no, cast(case when name is null then 1 else 2 end as int), code, 'code',
       '{HOST}/api/dataElements/' || id || '?fields=id,code&filter=code:eq:' || code, 'dhis2'
from f_element_meta where id is not null and code is not null
""", ["f_element_meta"]))
def identifiers(spark, sf):
    """PRJ4: identifier arrays of data elements, one row per entry."""
    recs = MP.to_identifiers(fx.load(spark, sf, "f_element_meta"), "dataElements", HOST, keep=["row_no"])
    x = recs.select("row_no", F.posexplode("identifier").alias("pos", "i"))
    return x.select("row_no", F.col("pos").cast("int"), "i.value", "i.property", "i.system", "i.type")


@query("payload_identifiers", fx.oracle(f"""
select name as value, 'name' as property, '{HOST}/api/dataElements/' || id || '?fields=id,name&filter=name:eq:' || name as system,
       'dhis2' as type, cast(0 as int) as pos from f_element_meta where id is not null and name is not null
union all
select id, 'id', '{HOST}/api/dataElements/' || id, 'dhis2', cast(case when name is null then 0 else 1 end as int) from f_element_meta where id is not null
union all
select code, 'code', '{HOST}/api/dataElements/' || id || '?fields=id,code&filter=code:eq:' || code, 'dhis2',
       cast(case when name is null then 1 else 2 end as int) from f_element_meta where id is not null and code is not null
""", ["f_element_meta"]))
def payload_identifiers(spark, sf):
    """FIL13 + PRJ4: identifiers of the records of a payload that has the resource, in the
    records' own key order (name, id, code); a resource it lacks gives none."""
    meta = fx.load(spark, sf, "f_element_meta")
    payload = (meta.groupBy((F.col("row_no") / 100).cast("long").alias("page"))
               .agg(F.collect_list(F.struct("name", "id", "code")).alias("dataElements")).drop("page"))
    recs = MP.payload_identifiers(payload, "dataElements", HOST).unionByName(MP.payload_identifiers(payload, "indicators", HOST))
    return recs.select(F.posexplode("identifier").alias("pos", "i")).select("i.*", F.col("pos").cast("int").alias("pos"))


@query("rename_back_nested", fx.oracle("""
select orgUnit, dataElement, period, categoryOptionCombo, attributeOptionCombo, value from f_payload
""", ["f_payload"]))
def rename_back_nested(spark, sf):
    """PRJ2 on nested payloads: {dataValues: [records]} by location, renamed inside the list."""
    wh = fx.load(spark, sf, "f_warehouse")
    fields = ["location", "id", "period", "disaggregation", "attribution", "value"]
    payload = wh.groupBy("location", "period").agg(F.collect_list(F.struct(*fields)).alias("dataValues")).select("dataValues")
    return MP.from_warehouse_payload(payload).select(F.explode("dataValues").alias("v")).select("v.*")


_FIXED = "".join(f" union all select uid, '{b}', {p}, '', '{t}', {s}, {y} from f_orgunit" for b, p, t, s, y in [
    ("status", 0, "regulatory", "null", "null"), ("status", 1, "operating", "null", "null"), ("status", 2, "validity", "null", "null"),
    ("status", 3, "activity", "null", "null"), ("tracking", 0, "openingDate", "null", "null"), ("tracking", 1, "closingDate", "null", "null"),
    ("tracking", 2, "maintenanceDate", "null", "null"), ("tracking", 3, "nextMaintenanceDate", "null", "null"),
    ("population", 0, "catchment", "'nbs'", "'2004'"),
    *[(f"location.{w}", p, t, "'nbs'", "null") for w in ("current", "historic")
      for p, t in enumerate(("latitude", "longitude", "address", "telecom"))]])


@query("facility_blocks", fx.oracle(f"""
select uid as id, 'identifier' as block, 0 as pos, '' as value, 'code' as type, 'DHIS2' as system, null as period from f_orgunit
union all select uid, 'identifier', 1, name, 'name', 'DHIS2', null from f_orgunit
union all select uid, 'identifier', 2, uid, 'id', 'DHIS2', null from f_orgunit{_FIXED}
""", ["f_orgunit"]))
def facility_blocks(spark, sf):
    """PRJ5: the fixed blocks of every facility by value, one row per entry."""
    f = _facility(spark, sf)
    out = None
    for block in ("identifier", "status", "tracking", "population", "location.current", "location.historic"):
        x = f.select("id", F.posexplode(block).alias("pos", "x"))
        names = x.schema["x"].dataType.names
        part = x.select("id", F.lit(block).alias("block"), F.col("pos").cast("int"), *[
            (F.col(f"x.{n}") if n in names else F.lit(None).cast("string")).alias(n) for n in ("value", "type", "system", "period")])
        out = part if out is None else out.unionByName(part)
    return out


@query("enrich_path", _rec(["f_orgunit", "f_location_doc"]) + """
select d.doc_id, d.location_id, d.status as location_status, t.path as location_path
from f_location_doc d left join tree t on t.uid = d.location_id
""")
def enrich_path(spark, sf):
    """JON8: documents with location.path from the unit list with stored paths (no match: NULL path)."""
    docs = fx.load(spark, sf, "f_location_doc")
    docs = docs.select("doc_id", F.struct(F.col("location_id").alias("id"), F.col("status"), F.col("amount")).alias("location"))
    units = unit_paths(spark, sf).select(F.col("uid").alias("id"), "path", F.col("organisationunitid").alias("row_no"))
    out = MP.enrich_location(docs, units)
    return out.select("doc_id", F.col("location.id").alias("location_id"), F.col("location.status").alias("location_status"),
                      F.col("location.path").alias("location_path"))


@query("data_values", _rec(["f_orgunit", "f_datavalue", "f_dataset_member"]) + """
select v.dataelementid, v.periodid, v.sourceid, v.categoryoptioncomboid, v.attributeoptioncomboid, v.value, v.storedby,
       v.lastupdated, v.comment, v.followup, v.created, v.deleted
from f_datavalue v
where v.periodid between 1994 and 1996
  and v.dataelementid in (select dataelementid from f_dataset_member where dataset_id = 'DS1')
  and v.sourceid in (select t.organisationunitid from tree t where t.path like '/R0000000001/%')
""")
def data_values(spark, sf):
    """FIL2: values of data set DS1 for the units below region R0000000001, periods 1994-1996."""
    ou = fx.load(spark, sf, "f_orgunit")
    below = H.descendants(unit_paths(spark, sf), ou.where(F.col("uid") == "R0000000001").select("uid"))
    units = below.join(ou.select("uid", "organisationunitid"), "uid")
    return MP.data_values(fx.load(spark, sf, "f_datavalue"), fx.load(spark, sf, "f_dataset_member"), "DS1",
                          units, 1994, 1996)


_TERMS = """
, incoming AS (select id, dataelement as name, shortname, 1 as type, 1 as system, 1 as "group" from f_term_incoming)
, stored AS (select id, name, shortname, type, system, term_group as "group" from f_term_stored)
, fresh AS (select * from incoming i where not exists (select 1 from stored s where s.id = i.id))
"""


def _terms(spark, sf):
    stored = fx.load(spark, sf, "f_term_stored").withColumnRenamed("term_group", "group")
    incoming = R.to_mappings(fx.load(spark, sf, "f_term_incoming"))
    return stored, incoming


@query("new_terms", fx.oracle(_TERMS + "select * from fresh", ["f_term_incoming", "f_term_stored"]))
def new_terms(spark, sf):
    """JON7: incoming terminology mappings not stored yet."""
    stored, incoming = _terms(spark, sf)
    return R.new_terms(stored, incoming)


@query("terms_upsert", fx.oracle(_TERMS + "select * from stored union all select * from fresh",
                                 ["f_term_incoming", "f_term_stored"]))
def terms_upsert(spark, sf):
    """REG2 / SET2: stored mappings extended with the missing incoming ones."""
    stored, incoming = _terms(spark, sf)
    return R.upsert_terms(stored, incoming)


@query("terms_from_response", """
select p_name as name, p_brand as shortname, 1 as type, 1 as system, 1 as "group" from part
""")
def terms_from_response(spark, sf):
    """SRC4 + PRJ10: {headers, rows} responses (pages of 100 parts; every other page has its
    headers the other way round) parsed and mapped to terms."""
    part = fx.raw(spark, sf, "part")
    odd, head = F.col("page") % 2 == 1, lambda *n: F.array(*[F.struct(F.lit(x).alias("name")) for x in n])
    pages = (part.withColumn("page", (F.col("p_partkey") / 100).cast("long"))
             .select("page", F.when(odd, F.array("p_brand", "p_name")).otherwise(F.array("p_name", "p_brand")).alias("row"))
             .groupBy("page").agg(F.collect_list("row").alias("rows"))
             .withColumn("headers", F.when(odd, head("shortname", "dataelement")).otherwise(head("dataelement", "shortname"))))
    return R.to_mappings(from_headers_rows(pages)).select("name", "shortname", "type", "system", "group")


@query("responses_mixed", """
select p_name as name, p_brand as brand, case when p_partkey // 20 % 3 = 2 then p_size end as size from part
""")
def responses_mixed(spark, sf):
    """SRC4: responses of 20 parts each, of which every third has a header more than the first."""
    part = fx.raw(spark, sf, "part").withColumn("page", F.floor(F.col("p_partkey") / 20))
    more = F.col("page") % 3 == 2
    head = lambda *n: F.array(*[F.struct(F.lit(x).alias("name")) for x in n])
    pages = (part.select("page", F.when(more, F.array("p_name", F.col("p_size").cast("string"), "p_brand")).otherwise(F.array("p_name", "p_brand")).alias("row"))
             .groupBy("page").agg(F.collect_list("row").alias("rows"))
             .withColumn("headers", F.when(more, head("name", "size", "brand")).otherwise(head("name", "brand"))))
    return from_headers_rows(pages).select("name", "brand", F.col("size").cast("int").alias("size"))


@query("facility_sorted", fx.oracle("select uid as id, row_number() over (order by uid) as place from f_orgunit", ["f_orgunit"]))
def facility_sorted(spark, sf):
    """PRJ9 / SRT2: places of the records in the files of the sorted export."""
    path = scratch_path(spark, "facility-sorted")
    R.to_facility(nested_units(spark, sf), sort=True).write.parquet(path)
    back = spark.read.parquet(path).select("id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"), F.lit(0).alias("all"))
    return row_numbers(back, ["all"], ["file", "row"], out="place").select("id", "place")
