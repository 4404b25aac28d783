"""Site directive (SIT1-4, SNK3, JON10) and hierarchy (SIT5, FIL1) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitmesh.operators import hierarchy as H
from unitmesh.operators import sites as S
from unitmesh.plans import fixtures as fx
from unitmesh.plans.materialize import materialize
from unitmesh.plans.registry import TODAY, query

FX = ("f_directive", "f_snapshot")


def _inputs(spark, sf):
    return fx.load(spark, sf, "f_directive"), fx.load(spark, sf, "f_snapshot")


_ADDS = """
, d AS (select * from f_directive where lower(coalesce(op, '')) = 'add')
, by_code AS (select code, arg_min(id, row_no) as code_parent from f_snapshot where code is not null group by code)
, known AS (select distinct id from f_snapshot)
, existing AS (select name, parent_id, arg_min(id, row_no) as existing_id from f_snapshot
               where parent_id is not null group by name, parent_id)
, a1 AS (select d.*, bc.code_parent, k.id as parent_known,
                case when coalesce(d.parent_uid, '') = '' then bc.code_parent else d.parent_uid end as resolved_parent,
                replace(d.name, '''', '''''') as name_q
         from d left join by_code bc on d.parent_code = bc.code left join known k on d.parent_uid = k.id)
, a0 AS (select a1.*, e.existing_id,
                case when coalesce(uid, '') = '' then 'uid_missing'
                     when coalesce(a1.name, '') = '' then 'name_missing'
                     when coalesce(parent_uid, '') = '' and coalesce(parent_code, '') = ''
                          then 'parent_missing'
                     when coalesce(parent_uid, '') = '' and code_parent is null then 'parent_code_unknown'
                     when coalesce(parent_uid, '') <> '' and parent_known is null then 'parent_uid_unknown'
                     when e.existing_id is not null then 'site_exists' end as reason
         from a1 left join existing e on a1.name_q = e.name and a1.resolved_parent = e.parent_id)
, a2 AS (select * exclude (reason), case when reason is null and row_number() over (partition by uid, reason is null order by row_no) > 1
                                         then 'uid_repeated' else reason end as reason from a0)
, adds AS (select row_no, uid as id, name,
                  case when coalesce(shortname, '') = '' then substring(name, 1, 50) else shortname end as shortName,
                  coalesce(code, '') as code, resolved_parent as parent_id, '1970-01-01' as openingDate,
                  case when coalesce(lon, '') <> '' and coalesce(lat, '') <> '' then 'POINT' end as featureType,
                  case when coalesce(lon, '') <> '' and coalesce(lat, '') <> '' then '[' || lon || ',' || lat || ']' end as coordinates
           from a2 where reason is null)
"""

_UPDATES = f"""
, e0 AS (select *, case when lower(op) = 'relocate' then 'relocate' else 'edit' end as kind from f_directive
         where lower(coalesce(op, '')) in ('edit', 'update', 'rename', 'relocate'))
, taken AS (select distinct code from f_snapshot where code is not null)
, e1 AS (select e0.*,
                case when s.id is null then 'site_unknown'
                     when kind = 'edit' and coalesce(parent_uid, '') <> '' and p.id is null then 'parent_uid_unknown'
                     when kind = 'relocate' and p.id is null then 'parent_uid_unknown'
                     when kind = 'edit' and coalesce(e0.code, '') <> '' and t.code is not null then 'code_taken'
                end as pre
         from e0 left join known s on e0.uid = s.id left join known p on e0.parent_uid = p.id
         left join taken t on e0.code = t.code)
, claims AS (select code, min(row_no) as claim_row from e1
             where pre is null and kind = 'edit' and coalesce(code, '') <> '' group by code)
, e2 AS (select e1.*, case when pre is null and kind = 'edit' and coalesce(e1.code, '') <> '' and e1.row_no <> c.claim_row
                           then 'code_taken' else pre end as reason
         from e1 left join claims c on e1.code = c.code)
, ch AS (select uid,
                arg_max(new_name, row_no) filter (where kind = 'edit' and coalesce(new_name, '') <> '') as new_name,
                arg_max(substring(case when coalesce(shortname, '') = '' then new_name else shortname end, 1, 50), row_no)
                    filter (where kind = 'edit' and coalesce(new_name, '') <> '') as new_short,
                arg_max('[' || lon || ', ' || lat || ']', row_no)
                    filter (where kind = 'edit' and coalesce(lat, '') <> '' and coalesce(lon, '') <> '') as new_coordinates,
                arg_max(parent_uid, row_no) filter (where coalesce(parent_uid, '') <> '') as new_parent,
                arg_max(code, row_no) filter (where kind = 'edit' and coalesce(code, '') <> '') as new_code,
                bool_or(kind = 'edit') as has_edit, bool_or(kind = 'relocate') as has_relocate
         from e2 where reason is null group by uid)
, st AS (select ch.uid as id, coalesce(new_name, s.name) as name, coalesce(new_short, s.shortName) as shortName,
                coalesce(new_code, s.code, '') as code, coalesce(new_parent, s.parent_id) as parent_id, s.openingDate,
                case when new_coordinates is not null then 'POINT' else s.featureType end as featureType,
                coalesce(new_coordinates, s.coordinates, '') as coordinates,
                case when has_relocate then coalesce(s.created, '') else s.created end as created,
                '{TODAY}' as lastUpdated, s.contact, s.attributeValues, has_edit, has_relocate
         from ch left join f_snapshot s on ch.uid = s.id)
"""


def _sql(tail: str) -> str:
    return fx.with_clause(list(FX), fx.DUCKDB_TABLES) + _ADDS + _UPDATES + tail


@query("dir_split", fx.oracle("""
select *, case when lower(coalesce(op, '')) = 'add' then 'add'
               when lower(coalesce(op, '')) in ('edit', 'update', 'rename') then 'edit'
               when lower(coalesce(op, '')) = 'relocate' then 'relocate' else 'unknown' end as kind
from f_directive
""", ["f_directive"]))
def dir_split(spark, sf):
    """SIT1: every directive with its kind (add / edit / relocate / unknown)."""
    return S.split_directives(fx.load(spark, sf, "f_directive"))


@query("site_adds", _sql("select * from adds"))
def site_adds(spark, sf):
    """SIT2: payload of the add directives that pass every check."""
    return S.site_adds(*_inputs(spark, sf))[0]


@query("site_edits", _sql("""
select id, name, shortName, code, parent_id, openingDate, featureType, coordinates, created, lastUpdated, contact, attributeValues from st where has_edit
"""))
def site_edits(spark, sf):
    """SIT3: edit batch, one row per site with its final state after all accepted edits and relocations."""
    d, s = _inputs(spark, sf)
    return S.site_updates(d, s, TODAY).edits


@query("site_relocates", _sql("""
select id, name, shortName, code, parent_id, openingDate, featureType, coordinates, created, lastUpdated, contact, attributeValues from st where has_relocate
"""))
def site_relocates(spark, sf):
    """SIT4: relocation batch (sites with an accepted relocation), final state."""
    d, s = _inputs(spark, sf)
    return S.site_updates(d, s, TODAY).relocates


@query("site_rejects", _sql("""
select row_no, op, uid, reason from a2 where reason is not null
union all
select row_no, op, uid, reason from e2 where reason is not null
union all
select row_no, op, uid, 'operation_unknown' from f_directive
where lower(coalesce(op, '')) not in ('add', 'edit', 'update', 'rename', 'relocate')
"""))
def site_rejects(spark, sf):
    """SIT2-4: every directive not carried out, with the first failed check."""
    d, s = _inputs(spark, sf)
    return S.all_rejects(d, S.site_adds(d, s)[1], S.site_updates(d, s, TODAY))


@query("site_apply", _sql("""
select s.id, coalesce(st.name, s.name) as name, coalesce(st.shortName, s.shortName) as shortName,
       coalesce(st.code, s.code) as code, coalesce(st.parent_id, s.parent_id) as parent_id,
       coalesce(st.openingDate, s.openingDate) as openingDate, coalesce(st.featureType, s.featureType) as featureType,
       coalesce(st.coordinates, s.coordinates) as coordinates, coalesce(st.created, s.created) as created, s.contact, s.attributeValues
from f_snapshot s left join st on s.id = st.id
union all
select id, name, shortName, code, parent_id, openingDate, featureType, coordinates, cast(null as varchar), cast(null as varchar), cast(null as varchar[])
from adds a where not exists (select 1 from f_snapshot s where s.id = a.id)
"""))
def site_apply(spark, sf):
    """SNK3: the snapshot after importing the batches (UPDATE strategy, MERGE mode) and the adds."""
    d, s = _inputs(spark, sf)
    adds, _ = S.site_adds(d, s)
    return S.apply_updates(s, S.site_updates(d, s, TODAY).state, adds.drop("row_no"))


@query("batch_counts", _sql("""
select (select count(*) from adds) as add_count, (select count(*) from st where has_edit) as edit_count,
       (select count(*) from st where has_relocate) as relocate_count
"""))
def batch_counts(spark, sf):
    """AGG11: number of sites in the add, edit and relocation batches."""
    d, s = _inputs(spark, sf)
    adds, _ = S.site_adds(d, s)
    upd = S.site_updates(d, s, TODAY)
    return S.batch_counts(adds, upd.edits, upd.relocates)


@query("site_codes_in_order", fx.with_clause(list(FX), fx.DUCKDB_TABLES, recursive=True) + """
, sites AS (select id, arg_min(code, row_no) filter (where code is not null) as code from f_snapshot group by id)
, d AS (select *, lower(op) in ('edit', 'update', 'rename') as is_edit from f_directive where lower(op) in ('edit', 'update', 'rename', 'relocate'))
, pre AS (select d.*, case when coalesce(uid, '') = '' or uid not in (select id from sites) then 'site_unknown'
                           when is_edit and coalesce(parent_uid, '') <> '' and parent_uid not in (select id from sites) then 'parent_uid_unknown'
                           when not is_edit and (coalesce(parent_uid, '') = '' or parent_uid not in (select id from sites)) then 'parent_uid_unknown' end as reason from d)
, claim AS (select row_no, uid, code, row_number() over (order by row_no) as k from pre where reason is null and is_edit and coalesce(code, '') <> '')
, walk AS (select 0::bigint as k, (select map_from_entries(list((id, code))) from sites where code is not null) as held, true as granted
           union all
           select c.k, case when list_contains(map_values(w.held), c.code) then w.held else map_concat(w.held, MAP([c.uid], [c.code])) end,
                  not list_contains(map_values(w.held), c.code)
           from walk w join claim c on c.k = w.k + 1)
, verdict AS (select c.row_no, w.granted from claim c join walk w using (k))
, last AS (select arg_max(held, k) as held from walk)
select p.row_no, p.op, p.uid, case when p.reason is not null then p.reason when v.granted = false then 'code_taken' end as reason,
       case when s.id is not null then coalesce(held[p.uid], '') end as final_code
from pre p left join verdict v using (row_no) left join sites s on s.id = p.uid, last
""")
def site_codes_in_order(spark, sf):
    """SIT3 in file order: every edit and relocation with its outcome, and the code its site
    has in the end; codes are freed and taken row by row."""
    d, s = _inputs(spark, sf)
    upd = S.site_updates(d, s, TODAY, in_order=True)
    rows = S.split_directives(d).where(F.col("kind").isin("edit", "relocate")).select("row_no", "op", "uid")
    codes = (s.groupBy(F.col("id").alias("uid")).agg(F.min_by("code", "row_no").alias("old"))
             .join(upd.state.select(F.col("id").alias("uid"), F.col("code").alias("new")), "uid", "left")
             .select("uid", F.coalesce("new", "old", F.lit("")).alias("final_code")))
    return rows.join(upd.rejects.select("row_no", "reason"), "row_no", "left").join(codes, "uid", "left").select("row_no", "op", "uid", "reason", "final_code")


@query("site_diff", fx.oracle("""
, f AS (select uid, arg_max(case when lower(op) = 'add' then name else new_name end, row_no) as file_name
        from f_directive where lower(coalesce(op, '')) in ('add', 'edit', 'update', 'rename') group by uid)
select coalesce(f.uid, s.id) as uid,
       case when s.id is null then 'added' when f.uid is null then 'missing'
            when coalesce(f.file_name, '') <> '' and f.file_name <> coalesce(s.name, '') then 'changed'
            else 'same' end as status,
       f.file_name, s.name as site_name
from f full outer join f_snapshot s on f.uid = s.id
""", list(FX)))
def site_diff(spark, sf):
    """JON10: file against snapshot per uid: added, changed, same or missing."""
    return S.site_diff(*_inputs(spark, sf))


_TREE = """
, tree AS (select organisationunitid, '/' || uid as path, 1 as level from f_orgunit where parentid is null
           union all
           select c.organisationunitid, t.path || '/' || c.uid, t.level + 1
           from f_orgunit c join tree t on c.parentid = t.organisationunitid )
"""


@query("paths", fx.with_clause(["f_tree"], fx.DUCKDB_TABLES, recursive=True) + """
, one AS (select organisationunitid, min(uid) as uid, arg_min(parentid, uid) as parentid from f_tree group by organisationunitid)
, tree AS (select organisationunitid, '/' || uid as path, 1 as level from one where parentid is null
           union all
           select c.organisationunitid, t.path || '/' || c.uid, t.level + 1 from one c join tree t on c.parentid = t.organisationunitid)
select o.organisationunitid, o.uid, o.parentid, t.path, cast(t.level as int) as level, t.path is not null as resolved
from one o left join tree t on o.organisationunitid = t.organisationunitid
""")
def paths(spark, sf):
    """SIT5: hierarchy path '/root/.../uid' and level of every unit (pointer doubling), over
    units with a chain of customers as deep as there are orders a customer may have,
    cycles, dangling parents and repeated ids."""
    return H.materialize_paths(fx.load(spark, sf, "f_tree"))


@query("paths_after_moves", fx.with_clause(["f_tree", "f_tree_change", "f_tree_removed"], fx.DUCKDB_TABLES, recursive=True) + """
, one AS (select organisationunitid, min(uid) as uid, arg_min(parentid, uid) as parentid from f_tree group by organisationunitid)
, after AS (select * from one where organisationunitid not in (select organisationunitid from f_tree_change)
                                and organisationunitid not in (select organisationunitid from f_tree_removed)
            union all select organisationunitid, uid, parentid from f_tree_change)
, tree AS (select organisationunitid, '/' || uid as path, 1 as level from after where parentid is null
           union all
           select c.organisationunitid, t.path || '/' || c.uid, t.level + 1 from after c join tree t on c.parentid = t.organisationunitid)
select o.organisationunitid, o.uid, o.parentid, t.path, cast(t.level as int) as level, t.path is not null as resolved
from after o left join tree t on o.organisationunitid = t.organisationunitid
""")
def paths_after_moves(spark, sf):
    """SIT5 after SIT4: stored paths brought up to date with units moved, renamed, added and
    removed; only the subtrees touched are computed anew."""
    stored = fx.load_built(spark, sf, "tree_paths", lambda: H.materialize_paths(fx.load(spark, sf, "f_tree")))
    updates = materialize(H.path_updates(stored, fx.load(spark, sf, "f_tree_change"), fx.load(spark, sf, "f_tree_removed")), "path-updates")
    return H.apply_path_updates(stored, updates)


_WALK = fx.with_clause(["f_tree"], fx.DUCKDB_TABLES, recursive=True) + """
, one AS (select organisationunitid, min(uid) as uid, arg_min(parentid, uid) as parentid from f_tree group by organisationunitid)
, tree AS (select organisationunitid, lpad(cast(organisationunitid as varchar), 10, '0') as key, 1 as level from one where parentid is null
           union all
           select c.organisationunitid, t.key || lpad(cast(c.organisationunitid as varchar), 10, '0'), t.level + 1
           from one c join tree t on c.parentid = t.organisationunitid)
, below AS (select key, count(*) - 1 as n from (select substr(key, 1, 10 * unnest(generate_series(1, level))) as key from tree) group by key)
"""


@query("interval_labels", _WALK + """
, walk AS (select t.*, row_number() over (order by key) as first from tree t)
select o.organisationunitid, o.uid, o.parentid, cast(w.level as int) as level, w.first, w.first + b.n as last
from walk w join one o using (organisationunitid) join below b using (key)
""")
def interval_labels(spark, sf):
    """FIL1 / SRC7: place of every unit in a walk through the tree and of the last below it."""
    return H.interval_labels(fx.load(spark, sf, "f_tree"))


@query("descendants_range", _WALK + """
select r.uid as root_uid, o.uid
from tree t join one o using (organisationunitid),
     (select key, one.uid from tree join one using (organisationunitid) join f_orgunit f using (organisationunitid) where f.level <= 2) r
where t.key like r.key || '_%'
""")
def descendants_range(spark, sf):
    """FIL1: the units below each region and nation, by a range filter on stored labels."""
    stored = fx.load_built(spark, sf, "tree_labels", lambda: H.interval_labels(fx.load(spark, sf, "f_tree")))
    return H.descendants_range(stored, fx.load(spark, sf, "f_orgunit").where("level <= 2").select("uid"))


@query("country_sites", fx.with_clause(["f_snapshot"], fx.DUCKDB_TABLES, recursive=True) + """
, below AS (select id from f_snapshot where parent_id = 'R0000000001'
            union all select c.id from f_snapshot c join below b on c.parent_id = b.id)
select * from f_snapshot where id in (select id from below)
""")
def country_sites(spark, sf):
    """SRC7: the snapshot rows strictly below one unit, at any depth."""
    return S.country_sites(fx.load(spark, sf, "f_snapshot"), "R0000000001")


@query("descendants", fx.with_clause(["f_orgunit"], fx.DUCKDB_TABLES, recursive=True) + _TREE + """
select r.uid as root_uid, o.uid
from f_orgunit o join tree t on o.organisationunitid = t.organisationunitid
join f_orgunit r on r.level = 1 and t.path like '/' || r.uid || '/%'
""")
def descendants(spark, sf):
    """FIL1: every unit below each top-level unit (ancestors.id = root, read from the
    stored unit paths), the root excluded."""
    from unitmesh.plans.q_registry import unit_paths

    ou = fx.load(spark, sf, "f_orgunit")
    return H.descendants(unit_paths(spark, sf), ou.where(F.col("level") == 1).select("uid"))
