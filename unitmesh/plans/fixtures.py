"""Stand-in inputs derived from the driver's test tables.

Each fixture is one SQL SELECT that runs unchanged in Spark and DuckDB. It only
reshapes the TPC-H-like tables into the schemas the operators expect (org units,
data values, merge requests, directives, ...); none of the operators' work happens
here. In Spark the raw tables are read straight from parquet; in the oracle they are
DuckDB views with the same names.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from unitmesh.plans.joins import split_repeated
from unitmesh.session import scratch_path, table_path

RAW_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()

# name -> (SQL body with {table} placeholders for raw tables and bare names for
# other fixtures, fixtures it depends on)
FIXTURES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _fx(name: str, deps: tuple[str, ...], sql: str) -> None:
    FIXTURES[name] = (sql.strip(), deps)


_fx("f_orgunit", (), """
select cast(1 + r_regionkey as int) as organisationunitid, concat('R', lpad(cast(r_regionkey as string), 10, '0')) as uid,
       r_name as name, concat('RC', cast(r_regionkey as string)) as code, cast(null as int) as parentid, cast(1 as int) as level
from {region}
union all
select cast(101 + n_nationkey as int), concat('N', lpad(cast(n_nationkey as string), 10, '0')), n_name,
       concat('NC', cast(n_nationkey % 20 as string)), cast(1 + n_regionkey as int), cast(2 as int)
from {nation}
union all
select cast(1001 + s_suppkey as int), concat('S', lpad(cast(s_suppkey as string), 10, '0')), s_name,
       case when s_suppkey % 7 = 0 then null else concat('SC', cast(s_suppkey as string)) end,
       cast(101 + s_nationkey as int), cast(3 as int)
from {supplier}
""")

# Units for paths: the org units, and the customers below them in chains of 150. Some
# customers are parents of each other (a cycle), some have an unknown parent, some ids repeat.
_fx("f_tree", ("f_orgunit",), """
select organisationunitid, uid, parentid from f_orgunit
union all
select cast(1000000 + c_custkey as int), concat('C', lpad(cast(c_custkey as string), 10, '0')),
       cast(case when c_custkey % 151 = 3 then 1000000 + c_custkey + 1 when c_custkey % 151 = 4 then 1000000 + c_custkey - 1
                 when c_custkey % 907 = 900 then 999999999 when c_custkey % 150 = 0 then 101 + c_nationkey else 1000000 + c_custkey - 1 end as int)
from {customer}
union all
select cast(1000000 + c_custkey as int), concat('D', lpad(cast(c_custkey as string), 10, '0')), cast(101 as int) from {customer} where c_custkey % 20 = 0
""")

# Changes to that tree: units moved elsewhere (some below one of their own units, which makes
# a cycle, some out of a cycle), renamed or added, and the parent that some lacked.
_fx("f_tree_change", (), """
select cast(1000000 + c_custkey as int) as organisationunitid,
       concat(case when c_custkey % 97 = 11 then 'M' else 'C' end, lpad(cast(c_custkey as string), 10, '0')) as uid,
       cast(case when c_custkey % 211 = 17 then 1000000 + c_custkey + 20 when c_custkey % 61 = 7 or c_custkey % 302 = 3 then 101 + c_nationkey
                 when c_custkey % 150 = 0 then 101 + c_nationkey else 1000000 + c_custkey - 1 end as int) as parentid
from {customer} where c_custkey % 211 = 17 or c_custkey % 61 = 7 or c_custkey % 302 = 3 or c_custkey % 97 = 11
union all
select cast(3000000 + c_custkey as int), concat('A', lpad(cast(c_custkey as string), 10, '0')), cast(1000000 + c_custkey as int) from {customer} where c_custkey % 50 = 9
union all
select cast(999999999 as int), concat('P', r_name), cast(1 as int) from {region} where r_regionkey = 0
""")

_fx("f_tree_removed", (), """
select cast(1000000 + c_custkey as int) as organisationunitid from {customer} where c_custkey % 331 = 100
""")

# Every fifth part key is an element; some elements of the value table are not in it.
_fx("f_dataelement", (), """
select distinct cast(floor(p_partkey / 5) as int) as dataelementid,
       case floor(p_partkey / 5) % 8 when 0 then 'INTEGER' when 1 then 'NUMBER' when 2 then 'INTEGER_ZERO_OR_POSITIVE'
            when 3 then 'INTEGER_POSITIVE' when 4 then 'TEXT' when 5 then 'INTEGER_NEGATIVE' when 6 then 'BOOLEAN' end as valuetype
from {part} where floor(p_partkey / 5) % 41 <> 7
""")

# All line items. attributeoptioncomboid numbers the rows that would share a value key.
# Some keys and update times are NULL; some rows of their own hold text.
_fx("f_datavalue", (), """
select cast(floor(l_partkey / 5) as int) as dataelementid, cast(year(l_shipdate) as int) as periodid, cast(1001 + l_suppkey as int) as sourceid,
       case when l_orderkey % 211 = 0 then cast(null as int) else cast(l_linenumber % 2 as int) end as categoryoptioncomboid,
       case when l_orderkey % 53 = 0 then cast(1000000 + l_orderkey * 10 + l_linenumber as int)
            else cast(row_number() over (partition by floor(l_partkey / 5), year(l_shipdate), l_suppkey, l_linenumber % 2, l_orderkey % 53 = 0
                                         order by l_shipdate desc, l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice) as int) end as attributeoptioncomboid,
       case when l_orderkey % 53 = 0 then 'n/a' else cast(cast(l_quantity as int) as string) end as value,
       l_linestatus as storedby, case when l_orderkey % 37 <> 0 then l_shipdate end as lastupdated,
       l_returnflag as comment, l_discount > 0.05 as followup, l_shipdate as created,
       case when l_orderkey % 17 = 0 then true when l_orderkey % 101 = 0 then null else false end as deleted
from {lineitem}
""")

# Values of up to 51 digits, 20 of them after the point: every line item's, under keys that
# pairs of sites share.
_fx("f_long_value", ("f_datavalue",), """
select dataelementid, periodid, sourceid, categoryoptioncomboid, cast(1 + attributeoptioncomboid % 2 as int) as attributeoptioncomboid,
       concat(cast(1 + dataelementid as string), lpad(cast(cast(sourceid as bigint) * 7919 as string), 12, '3'), lpad(cast(cast(attributeoptioncomboid as bigint) * 104729 as string), 16, '7'), '.',
              lpad(cast(cast(sourceid as bigint) * 6700417 as string), 20, '9')) as value,
       storedby, lastupdated, comment, followup, created, deleted
from f_datavalue where value <> 'n/a'
""")

# Two thirds of the sites are touched, in pairs of neighbours.
_fx("f_merge_map", (), """
select cast(1001 + s_suppkey as int) as source_id, cast(1000 + s_suppkey as int) as dest_id from {supplier}
where s_suppkey % 6 = 1 or s_suppkey % 6 = 5
""")

# Merge requests in an order that matters, in groups of six neighbours: several sources of a
# destination, the destination then a source itself and, in half the groups, filled again.
# Step k of all groups touches different sites.
_fx("f_merge_sequence", (), """
select cast(step * 1000000 + b as int) as request_no, cast(1001 + b + src as int) as source_id, cast(1001 + b + dst as int) as dest_id,
       case (cast(floor(b / 6) as int) * 2 + step * (1 + cast(floor(b / 12) as int) % 2)) % 6
            when 0 then 'AVG' when 1 then 'SUM' when 2 then 'LAST' when 3 then 'AVG' when 4 then 'MAX' else case when b % 4 = 0 then 'MIN' else 'FIRST' end end as strategy
from (select cast(s_suppkey as int) as b, cast(floor(s_suppkey / 6) as int) % 2 as odd from {supplier}
      where s_suppkey % 6 = 0 and s_suppkey + 5 <= (select max(s_suppkey) from {supplier})) g
join (select 0 as odd, 1 as step, 1 as src, 0 as dst union all select 0, 2, 2, 0 union all select 0, 3, 0, 3 union all select 0, 4, 4, 3
      union all select 0, 5, 3, 0 union all select 1, 1, 1, 0 union all select 1, 2, 3, 2 union all select 1, 3, 2, 0
      union all select 1, 4, 4, 0) s on s.odd = g.odd
""")

# Merge requests by uid with some invalid ones: unknown source or destination,
# self-merges, a lower-case strategy, sources with children (nations), repeated
# sources and chains (a destination that is also a source).
_fx("f_merge_request", (), """
select cast(s_suppkey as int) as request_no,
       case when s_suppkey % 23 = 0 then concat('Z', lpad(cast(s_suppkey as string), 10, '0'))
            when s_suppkey % 19 = 0 then concat('N', lpad(cast(s_nationkey as string), 10, '0'))
            else concat('S', lpad(cast(s_suppkey as string), 10, '0')) end as source_uid,
       case when s_suppkey % 17 = 0 then concat('Q', lpad(cast(s_suppkey as string), 10, '0'))
            when s_suppkey % 13 = 0 then concat('S', lpad(cast(s_suppkey as string), 10, '0'))
            else concat('S', lpad(cast(s_suppkey - 1 as string), 10, '0')) end as dest_uid,
       case when s_suppkey % 11 = 0 then 'sum' when s_suppkey % 3 = 0 then 'LAST' else 'SUM' end as strategy
from {supplier} where s_suppkey % 2 = 1 or s_suppkey % 10 = 4
""")

_fx("f_member", (), """
select objectid, organisationunitid, cast(row_number() over (partition by objectid order by d, organisationunitid) - 1 as int) as sort_order
from (select objectid, organisationunitid, min(o_orderdate) as d
      from (select cast(floor(o_custkey / 20) as int) as objectid,
                   cast(1001 + o_orderkey % (select count(*) from {supplier}) as int) as organisationunitid, o_orderdate from {orders}) o
      group by objectid, organisationunitid) t
""")

_fx("f_stage_instance", (), """
select o_orderkey as programstageinstanceid, cast(1001 + o_custkey % (select count(*) from {supplier}) as int) as organisationunitid
from {orders}
""")

_fx("f_stage_value", (), """
select l_orderkey as programstageinstanceid, l_linenumber as dataelementid, l_quantity as value from {lineitem}
""")

# Sites to delete: every third supplier, some nations (which have children, so
# they are refused) and an uid that matches nothing.
_fx("f_delete_request", (), """
select concat('S', lpad(cast(s_suppkey as string), 10, '0')) as uid from {supplier} where s_suppkey % 3 = 0
union all
select concat('N', lpad(cast(n_nationkey as string), 10, '0')) from {nation} where n_nationkey % 10 = 3
union all
select concat('X', lpad(cast(r_regionkey as string), 10, '0')) from {region} where r_regionkey = 2
""")

# Bulk directives, one for each customer: some repeat a uid, some cells are blank, some
# names hold quotes, commas, line breaks or backslashes or are long, some parents are
# given by code. The uids reach a tenth beyond the sites.
_fx("f_directive", (), """
select c_custkey as row_no,
       case c_custkey % 6 when 0 then 'add' when 1 then 'Edit' when 2 then 'UPDATE' when 3 then 'rename' when 4 then 'Relocate' else 'merge' end as op,
       case when c_custkey % 78 = 0 then '' when c_custkey % 66 = 0 then concat('X', lpad(cast(c_custkey - 6 as string), 10, '0'))
            when c_custkey % 6 = 0 then concat('X', lpad(cast(c_custkey as string), 10, '0'))
            else concat('S', lpad(cast(c_custkey % (select cast(count(*) * 1.1 as bigint) from {supplier}) as string), 10, '0')) end as uid,
       case when c_custkey % 29 = 0 then '' when c_custkey % 36 = 0 then concat('NATION_', cast(c_custkey % 25 as string))
            when c_custkey % 17 = 0 then concat('Clinic "', c_name, '", north', chr(10), 'wing', chr(92))
            when c_custkey % 19 = 0 then concat('O', chr(39), 'Site ', c_name) when c_custkey % 23 = 0 then repeat(c_name, 5)
            else c_name end as name,
       case when c_custkey % 36 = 0 then concat('R', lpad(cast(c_custkey % 5 as string), 10, '0')) when c_custkey % 7 = 0 then ''
            else concat('N', lpad(cast(c_custkey % 28 as string), 10, '0')) end as parent_uid,
       case when c_custkey % 3 = 0 then '' when c_custkey % 23 = 0 then repeat(c_name, 5) else concat('New ', c_name) end as new_name,
       case when c_custkey % 4 = 0 then '' else cast(c_custkey % 90 as string) end as lat,
       case when c_custkey % 4 = 1 then '' else cast(c_custkey % 180 as string) end as lon,
       case when c_custkey % 2 = 0 then '' else c_mktsegment end as shortname,
       case when c_custkey % 8 = 1 then concat('SC', cast(c_custkey % 300 as string)) else '' end as code,
       case when c_custkey % 84 = 0 then concat('NC', cast(c_custkey % 22 as string)) else '' end as parent_code
from {customer}
""")

# Site snapshot as the directive jobs see it (flat: the parent is its uid).
_fx("f_snapshot", ("f_orgunit",), """
select c.uid as id, c.name, substring(c.name, 1, 50) as shortName, c.code, p.uid as parent_id,
       '1970-01-01' as openingDate,
       case when c.level = 3 then 'POINT' else cast(null as string) end as featureType,
       case when c.level = 3 then concat('[', cast(c.organisationunitid % 180 as string), ', ', cast(c.organisationunitid % 90 as string), ']')
            else cast(null as string) end as coordinates,
       case when c.level < 3 then '2015-01-01' else cast(null as string) end as created,
       case when c.level = 3 then concat('Contact ', c.uid) end as contact,
       split(concat('a', cast(c.organisationunitid as string), ',b'), ',') as attributeValues,
       c.organisationunitid as row_no
from f_orgunit c left join f_orgunit p on c.parentid = p.organisationunitid
""")

# dataValues payload records in reporting-system names.
_fx("f_payload", ("f_orgunit", "f_datavalue"), """
select o.uid as orgUnit, concat('DE', cast(d.dataelementid as string)) as dataElement, cast(d.periodid as string) as period,
       'COC' || cast(d.categoryoptioncomboid as string) as categoryOptionCombo,
       concat('AOC', cast(d.attributeoptioncomboid as string)) as attributeOptionCombo,
       d.value, d.storedby, d.comment, d.followup
from f_datavalue d join f_orgunit o on d.sourceid = o.organisationunitid
""")

# Data element metadata (id, name, code, valueType, formName); some ids and codes missing.
_fx("f_element_meta", (), """
select p_partkey as row_no,
       case when p_partkey % 13 = 0 then cast(null as string) else concat('de', lpad(cast(p_partkey as string), 9, '0')) end as id,
       p_name as name,
       case when p_partkey % 5 = 0 then cast(null as string) else concat('C', cast(p_partkey as string)) end as code,
       case p_size % 3 when 0 then 'NUMBER' when 1 then 'TEXT' else 'INTEGER' end as valueType,
       p_type as formName
from {part}
""")

# Documents that carry a location reference (some ids unknown).
_fx("f_location_doc", (), """
select o_orderkey as doc_id, concat('S', lpad(cast(o_custkey % 1200 as string), 10, '0')) as location_id,
       o_orderstatus as status, o_totalprice as amount
from {orders}
""")

# Terminology: incoming data elements and the mappings already stored.
_fx("f_term_incoming", (), """
select concat('de', lpad(cast(p_partkey as string), 9, '0')) as id,
       case when p_partkey % 7 = 0 then concat(p_name, ' (new)') else p_name end as dataelement, p_brand as shortname
from {part}
""")

_fx("f_term_stored", (), """
select concat('de', lpad(cast(p_partkey as string), 9, '0')) as id, p_name as name, p_brand as shortname,
       cast(1 as int) as type, cast(1 as int) as system, cast(1 as int) as term_group
from {part} where p_partkey % 3 = 0
""")

# Name pairs to score: each part name against the next part's name.
_fx("f_name_pair", (), """
select a.p_partkey as pair_id, a.p_name as left_name, b.p_name as right_name
from {part} a join {part} b on b.p_partkey = a.p_partkey + 1
""")

# Titles of all documents and of all conversation turns: their first three words, accents
# taken off (DuckDB's similarity compares bytes).
_fx("f_title", (), """
select 0 as side, translate(substring(concat(split_part(text, ' ', 1), ' ', split_part(text, ' ', 2), ' ', split_part(text, ' ', 3)), 1, 40),
         'ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü', 'ACEEEINOOUsaceeeinoou') as title from {documents} where text is not null
union all
select 1, translate(substring(concat(split_part(text, ' ', 1), ' ', split_part(text, ' ', 2), ' ', split_part(text, ' ', 3)), 1, 40),
         'ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü', 'ACEEEINOOUsaceeeinoou') as title from {conversations} where text is not null
""")

# Group memberships of the suppliers: a balance band and, for even keys, a second group.
_fx("f_unit_group", (), """
select concat('S', lpad(cast(s_suppkey as string), 10, '0')) as uid,
       concat('GB', cast(cast(floor((s_acctbal + 1000) / 2500) as int) as string)) as group_id,
       concat('BAND', cast(cast(floor((s_acctbal + 1000) / 2500) as int) as string)) as group_code,
       concat('Balance band ', cast(cast(floor((s_acctbal + 1000) / 2500) as int) as string)) as group_name
from {supplier}
union all
select concat('S', lpad(cast(s_suppkey as string), 10, '0')), 'GEVEN', cast(null as string), 'Even supplier'
from {supplier} where s_suppkey % 2 = 0
""")

# Data set membership of the data elements.
_fx("f_dataset_member", ("f_dataelement",), """
select concat('DS', cast(dataelementid % 3 as string)) as dataset_id, dataelementid from f_dataelement
""")

# Warehouse-named value records (the reverse of f_payload's names).
_fx("f_warehouse", ("f_payload",), """
select orgUnit as location, dataElement as id, period, categoryOptionCombo as disaggregation,
       attributeOptionCombo as attribution, value, storedby, comment, followup
from f_payload
""")


def _order(names: list[str]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for d in FIXTURES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_clause(names: list[str], tables: dict[str, str], recursive: bool = False) -> str:
    """``WITH f_a AS (...), f_b AS (...)`` for the named fixtures and their deps."""
    parts = []
    for n in _order(names):
        body = FIXTURES[n][0].format(**tables)
        parts.append(f"{n} AS (\n{body}\n)")
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n"


DUCKDB_TABLES = {t: t for t in RAW_TABLES}


def spark_tables(sf_dir: str) -> dict[str, str]:
    return {t: f"parquet.`{table_path(sf_dir, t)}`" for t in RAW_TABLES}


def oracle(sql: str, names: list[str]) -> str:
    """Oracle text: the fixtures inlined as CTEs ahead of ``sql``."""
    return with_clause(names, DUCKDB_TABLES) + sql.strip()


_WRITTEN: dict[tuple[str, str, str], str] = {}
_FRAMES: dict[tuple[str, str, str], DataFrame] = {}


# f_datavalue's numbering, whose window would shuffle and sort every line item.
_LINE_KEY = ("floor(l_partkey / 5)", "year(l_shipdate)", "l_suppkey", "l_linenumber % 2")
_NUMBERING = re.compile(r"row_number\(\) over \(partition by .*?\n\s*order by [^)]*\)")


def _select(spark: SparkSession, sql: str, **views: DataFrame) -> DataFrame:
    """``sql`` over the views it names in braces."""
    names = {n: f"unitmesh_{n}_{uuid.uuid4().hex[:12]}" for n in views}
    try:
        for n, df in views.items():
            df.createOrReplaceTempView(names[n])
        return spark.sql(sql.format(**names))
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)


def _datavalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """f_datavalue's rows: only line items that may share a key are numbered by its window,
    the others are the first and only one of their key."""
    sql = FIXTURES["f_datavalue"][0]
    numbered = F.expr("not coalesce(l_orderkey % 53 = 0, false)")  # the others' number is computed
    lines = spark.read.parquet(table_path(sf_dir, "lineitem"))
    shared, alone = split_repeated(lines, F.when(numbered, F.xxhash64(*map(F.expr, _LINE_KEY))))
    out = _select(spark, sql, lineitem=shared)
    return out if alone is None else out.unionByName(_select(spark, _NUMBERING.sub("1", sql), lineitem=alone))


# Fixtures that Spark builds otherwise than by their SQL, with the same rows.
_BUILT = {"f_datavalue": _datavalue}


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture computed from the raw parquet tables in ``sf_dir``."""
    built = {n: _BUILT[n](spark, sf_dir) for n in _order([name]) if n in _BUILT}
    if name in built:
        return built[name]
    tables = spark_tables(sf_dir)
    parts = [f"{n} AS (\n{f'select * from {{{n}}}' if n in built else FIXTURES[n][0].format(**tables)}\n)" for n in _order([name])]
    return _select(spark, "WITH " + ",\n".join(parts) + f"\nSELECT * FROM {name}", **built)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a table: derived once per session and ``sf_dir``, written as
    parquet to the shared checkpoint folder and read from there, the way the
    operators would read real inputs. Later calls reuse the written table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key in _FRAMES:  # the written table never changes: reuse its DataFrame
        return _FRAMES[key]
    path = _WRITTEN.get(key)
    if path is not None:
        try:
            df = spark.read.parquet(path)
            _FRAMES[key] = df
            return df
        except Exception:  # folder cleaned up meanwhile: derive again
            _WRITTEN.pop(key, None)
    path = scratch_path(spark, f"input-{name}")
    derive(spark, sf_dir, name).write.parquet(path)
    _WRITTEN[key] = path
    _FRAMES[key] = spark.read.parquet(path)
    return _FRAMES[key]


def load_built(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Like :func:`load` for a stand-in input built by a function (e.g. units with
    their stored paths): built once per session and ``sf_dir``, then read as a table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    path = _WRITTEN.get(key)
    if path is not None:
        try:
            return spark.read.parquet(path)
        except Exception:
            _WRITTEN.pop(key, None)
    path = scratch_path(spark, f"input-{name}")
    build().write.parquet(path)
    _WRITTEN[key] = path
    return spark.read.parquet(path)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
