"""Merge queries (MRG0, MRG1, SNK1) and their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitmesh.operators import buckets as B
from unitmesh.operators import merge as M
from unitmesh.operators import replay as R
from unitmesh.plans import fixtures as fx
from unitmesh.plans.registry import RUN_TS, query
from unitmesh.session import scratch_path

BUCKETS = 64
FX = ("f_datavalue", "f_dataelement", "f_merge_map")


def _merge(spark, sf, strategy):
    res = M.merge_values(fx.load(spark, sf, "f_datavalue"), fx.load(spark, sf, "f_dataelement"),
                         fx.load(spark, sf, "f_merge_map"), strategy, RUN_TS)
    return res


def _shared(strat: str) -> str:
    """Shared oracle CTEs after ``sites``: element classes, live rows with key counts, and
    the branches of other value types and single rows. ``strat`` joins each destination's
    strategy where requests name one."""
    return f"""
, cls AS (select dataelementid,
                 max(coalesce(valuetype in ('INTEGER','NUMBER','INTEGER_ZERO_OR_POSITIVE','INTEGER_POSITIVE'), false)) as is_num,
                 max(coalesce(valuetype not in ('INTEGER','NUMBER','INTEGER_ZERO_OR_POSITIVE','INTEGER_POSITIVE'), false)) as is_oth
          from f_dataelement group by dataelementid)
, live AS (select d.*, s.dest, {'ds.strat, ' if strat else ''}coalesce(c.is_num, false) as is_num, coalesce(c.is_oth, false) as is_oth
           from f_datavalue d join sites s on d.sourceid = s.sourceid {strat}
           left join cls c on d.dataelementid = c.dataelementid
           where d.deleted = false)
, cnt AS (select dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid, count(*) as n
          from live group by dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid)
, krows AS (select l.*, c.n from live l join cnt c
            on l.dest = c.dest and l.dataelementid = c.dataelementid and l.periodid = c.periodid
            and l.categoryoptioncomboid = c.categoryoptioncomboid and l.attributeoptioncomboid = c.attributeoptioncomboid)
, other AS (select dataelementid, periodid, dest as sourceid, categoryoptioncomboid, value, storedby,
                   TIMESTAMP '{RUN_TS}' as lastupdated, comment, followup, attributeoptioncomboid, created, deleted
            from (select *, rank() over (partition by dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid
                                         order by lastupdated desc nulls first, sourceid) as rnk
                  from krows where n > 1 and is_oth) t where rnk = 1)
, single AS (select dataelementid, periodid, dest as sourceid, categoryoptioncomboid, value, storedby,
                    TIMESTAMP '{RUN_TS}' as lastupdated, comment, followup, attributeoptioncomboid, created, deleted
             from krows where n = 1)
"""


_BASE = """
, sites AS (select source_id as sourceid, dest_id as dest from f_merge_map
            union select dest_id, dest_id from f_merge_map)
""" + _shared("")


def _agg_sql(fn: str) -> str:
    val = f"{fn}(cast(value as decimal(38,10)))"
    return f"""
, numeric AS (select dataelementid, periodid, dest as sourceid, categoryoptioncomboid,
                     regexp_replace(regexp_replace(cast(cast({val} as decimal(38,10)) as varchar), '0+$', ''), '[.]$', '') as value,
                     'admin' as storedby, TIMESTAMP '{RUN_TS}' as lastupdated, cast(null as varchar) as comment, false as followup,
                     attributeoptioncomboid, TIMESTAMP '{RUN_TS}' as created, false as deleted
              from krows where n > 1 and is_num
              group by dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid)
"""


def _rank_sql(order: str) -> str:
    return f"""
, numeric AS (select distinct dataelementid, periodid, dest as sourceid, categoryoptioncomboid, value, storedby, lastupdated,
                     comment, followup, attributeoptioncomboid, created, deleted
              from (select *, rank() over (partition by dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid
                                           order by {order}) as rnk
                    from krows where n > 1 and is_num) t where rnk = 1)
"""


_STAGED = """
select * from numeric union all select * from other union all select * from single
"""


def _text(numeric_cte: str, tail: str = _STAGED) -> str:
    # fixtures first, then the shared CTEs, the strategy CTE and the final select
    return fx.with_clause(list(FX), fx.DUCKDB_TABLES) + _BASE + numeric_cte + tail


def _register_strategy(strategy: str, numeric_cte: str) -> None:
    name = f"merge_{strategy.lower()}"

    def build(spark, sf, _s=strategy):
        return _merge(spark, sf, _s).staged

    build.__doc__ = (f"MRG1 with strategy {strategy}: the staged rows that replace every row of the "
                     f"merged sources and destinations of f_merge_map.")
    query(name, _text(numeric_cte))(build)


_register_strategy("SUM", _agg_sql("sum"))
_register_strategy("AVG", _agg_sql("avg"))
_register_strategy("MAX", _agg_sql("max"))
_register_strategy("MIN", _agg_sql("min"))
_register_strategy("FIRST", _rank_sql("lastupdated asc nulls last"))
_register_strategy("LAST", _rank_sql("lastupdated desc nulls first"))


@query("merge_bucketed", _text(_agg_sql("sum"), """
select dataelementid, periodid, sourceid, categoryoptioncomboid, value, storedby, lastupdated, comment, followup,
       attributeoptioncomboid, created, deleted
from f_datavalue d where not exists (select 1 from sites s where s.sourceid = d.sourceid)
union all
select * from numeric union all select * from other union all select * from single
"""))
def merge_bucketed(spark, sf):
    """SNK1 by bucket: the SUM merge applied to a stored value table, only the buckets of the
    merged sites rewritten, and the stored table after it."""
    dv = fx.load(spark, sf, "f_datavalue")
    path = scratch_path(spark, "dv-buckets")
    B.write_buckets(dv, path, "sourceid", BUCKETS)
    stored = B.read_buckets(spark, path, dv.schema).drop(B.BUCKET)
    res = M.merge_values(stored, fx.load(spark, sf, "f_dataelement"), fx.load(spark, sf, "f_merge_map"), "SUM", RUN_TS)
    B.replace_sites_stored(spark, path, dv.schema, res.staged, res.sites.select("sourceid").distinct(), BUCKETS)
    return B.read_buckets(spark, path, dv.schema).select(*dv.columns)


def _exact_sql() -> str:
    """SUM, AVG (10 digits) and MAX by limbs of hugeint: whole digits in 18s, 20 after the point."""
    cut = "split_part(value, '.', 1)"
    limb = lambda k: f"cast(substr(lpad({cut}, 36, '0'), {18 * k + 1}, 18) as hugeint)"
    return fx.with_clause(["f_long_value", "f_dataelement", "f_merge_map"], fx.DUCKDB_TABLES) + """
, sites AS (select source_id as sourceid, dest_id as dest from f_merge_map union select dest_id, dest_id from f_merge_map)
, num AS (select distinct dataelementid from f_dataelement where valuetype in ('INTEGER','NUMBER','INTEGER_ZERO_OR_POSITIVE','INTEGER_POSITIVE'))
, v AS (select s.dest, d.*, """ + f"""{limb(0)} as hi, {limb(1)} as mid, cast(split_part(value, '.', 2) as hugeint) as lo""" + """
        from f_long_value d join sites s using (sourceid) join num using (dataelementid) where d.deleted = false)
, t AS (select dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid, count(*) as n, sum(hi) as hi, sum(mid) as mid, sum(lo) as lo,
               max(lpad(split_part(value, '.', 1), 40, '0') || '.' || split_part(value, '.', 2)) as top
        from v where categoryoptioncomboid is not null group by all having count(*) > 1)
, c AS (select *, mid + lo // 100000000000000000000 as mid1, lo % 100000000000000000000 as lo1 from t)
, w AS (select *, hi + mid1 // 1000000000000000000 as hi2, mid1 % 1000000000000000000 as mid2 from c)
, q AS (select *, hi2 // n as qh, ((hi2 % n) * 1000000000000000000 + mid2) // n as qm, ((hi2 % n) * 1000000000000000000 + mid2) % n as rm from w)
, a AS (select *, (rm * 100000000000 + lo1 // 1000000000) // n as q11 from q)
, r AS (select *, (q11 + 5) // 10 as q10 from a)
, x AS (select *, qm + q10 // 10000000000 as qm1, q10 % 10000000000 as f10 from r)
, texts AS (
  select dest as sourceid, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid,
         ltrim(cast(hi2 as varchar) || lpad(cast(mid2 as varchar), 18, '0'), '0') || '.' || lpad(cast(lo1 as varchar), 20, '0') as s,
         ltrim(cast(qh + qm1 // 1000000000000000000 as varchar) || lpad(cast(qm1 % 1000000000000000000 as varchar), 18, '0'), '0') || '.' || lpad(cast(f10 as varchar), 10, '0') as m,
         ltrim(top, '0') as h from x)
select sourceid, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid,
       rtrim(rtrim(s, '0'), '.') as sum_value, rtrim(rtrim(m, '0'), '.') as avg_value, rtrim(rtrim(h, '0'), '.') as max_value
from texts
"""


@query("merge_exact", _exact_sql())
def merge_exact(spark, sf):
    """AGG3-AGG5 / SCL9: SUM, AVG and MAX of values of up to 51 digits, none lost."""
    key = ["sourceid", "dataelementid", "periodid", "categoryoptioncomboid", "attributeoptioncomboid"]
    out = None
    for strategy, name in (("SUM", "sum_value"), ("AVG", "avg_value"), ("MAX", "max_value")):
        res = M.merge_values(fx.load(spark, sf, "f_long_value"), fx.load(spark, sf, "f_dataelement"), fx.load(spark, sf, "f_merge_map"), strategy, RUN_TS)
        got = res.staged.where("storedby = 'admin'").select(*key, F.col("value").alias(name))
        out = got if out is None else out.join(got, key)
    return out


def _replay_sql(steps: int) -> str:
    """The requests of one step touch different sites, so the steps are merged one after
    another, each over what the step before left. Numbers are counted in ten-digit parts."""
    key = "dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid"
    cols = ("dataelementid, periodid, sourceid, categoryoptioncomboid, value, storedby, lastupdated, comment, followup, "
            "attributeoptioncomboid, created, deleted")
    moved = cols.replace("sourceid", "dest as sourceid")
    now = f"TIMESTAMP '{RUN_TS}'"
    stamped = moved.replace("lastupdated", f"{now} as lastupdated")
    text = fx.with_clause(["f_merge_sequence", "f_datavalue", "f_dataelement"], fx.DUCKDB_TABLES) + f"""
, cls AS (select dataelementid, max(coalesce(valuetype in ('INTEGER','NUMBER','INTEGER_ZERO_OR_POSITIVE','INTEGER_POSITIVE'), false)) as is_num,
                 max(coalesce(valuetype not in ('INTEGER','NUMBER','INTEGER_ZERO_OR_POSITIVE','INTEGER_POSITIVE'), false)) as is_oth
          from f_dataelement group by dataelementid)
, s0 AS MATERIALIZED (select {cols} from f_datavalue
  where sourceid in (select source_id from f_merge_sequence union select dest_id from f_merge_sequence))"""
    for k in range(1, steps + 1):
        text += f"""
, m{k} AS MATERIALIZED (select source_id as site, dest_id as dest, strategy as strat from f_merge_sequence where request_no // 1000000 = {k}
  union all select dest_id, dest_id, strategy from f_merge_sequence where request_no // 1000000 = {k})
, k{k} AS MATERIALIZED (
  select v.*, m.dest, m.strat, coalesce(c.is_num, false) as is_num, coalesce(c.is_oth, false) as is_oth, count(*) over (partition by {key}) as n,
         rank() over (partition by {key} order by lastupdated asc nulls last) as oldest,
         rank() over (partition by {key} order by lastupdated desc nulls first) as newest,
         rank() over (partition by {key} order by lastupdated desc nulls first, v.sourceid) as winner,
         try_cast(split_part(value, '.', 1) as hugeint) * 10000000000 + try_cast(rpad(split_part(value, '.', 2), 10, '0') as hugeint) as num
  from s{k - 1} v join m{k} m on m.site = v.sourceid left join cls c using (dataelementid)
  where v.deleted = false and dataelementid is not null and periodid is not null and categoryoptioncomboid is not null and attributeoptioncomboid is not null)
, a{k} AS (select {key}, case strat when 'SUM' then sum(num) when 'AVG' then (2 * sum(num) + count(num)) // (2 * count(num))
                                    when 'MAX' then max(num) else min(num) end::hugeint as num
  from k{k} where n > 1 and is_num and strat in ('SUM', 'AVG', 'MAX', 'MIN') group by {key}, strat)
, s{k} AS MATERIALIZED (
  select {cols} from s{k - 1} where sourceid not in (select site from m{k})
  union all
  select dataelementid, periodid, dest, categoryoptioncomboid,
         rtrim(rtrim(cast(num // 10000000000 as varchar) || '.' || lpad(cast(num % 10000000000 as varchar), 10, '0'), '0'), '.'),
         'admin', {now}, null, false, attributeoptioncomboid, {now}, false from a{k}
  union all
  (select distinct {moved} from k{k} where n > 1 and is_num and ((strat = 'FIRST' and oldest = 1) or (strat = 'LAST' and newest = 1)))
  union all
  select {stamped} from k{k} where n > 1 and is_oth and winner = 1
  union all
  select {stamped} from k{k} where n = 1)"""
    return text + f"\nselect {cols} from s{steps}\n"


@query("merge_in_order", _replay_sql(5))
def merge_in_order(spark, sf):
    """MRG1 in request order: merges replayed one after another, chains and refilled sites
    included; the rows that replace those of every touched site of f_merge_sequence."""
    return R.replay_merges(fx.load(spark, sf, "f_datavalue"), fx.load(spark, sf, "f_dataelement"),
                           fx.load(spark, sf, "f_merge_sequence"), RUN_TS).staged


@query("merge_ties", _text(_rank_sql("lastupdated desc nulls first"), """
select sourceid as dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid, count(*) as winners
from numeric group by sourceid, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid having count(*) > 1
"""))
def merge_ties(spark, sf):
    """MRG1 rule 3: LAST-strategy keys whose latest rows differ (kept in the output, flagged here)."""
    return _merge(spark, sf, "LAST").ties


@query("merge_lost", _text("", """
select dataelementid, periodid, sourceid, categoryoptioncomboid, value, storedby, lastupdated, comment, followup,
       attributeoptioncomboid, created, deleted, dest, 'no value type' as reason
from krows where n > 1 and not is_num and not is_oth
union all
select dataelementid, periodid, sourceid, categoryoptioncomboid, value, storedby, lastupdated, comment, followup,
       attributeoptioncomboid, created, deleted, dest, 'null key' as reason
from live where dataelementid is null or periodid is null or categoryoptioncomboid is null or attributeoptioncomboid is null
"""))
def merge_lost(spark, sf):
    """MRG1 side output: live rows of merged sites the rules drop (untyped overlaps, NULL keys)."""
    return _merge(spark, sf, "SUM").lost


@query("merge_apply", _text(_agg_sql("sum"), """
select dataelementid, periodid, sourceid, categoryoptioncomboid, value, storedby, lastupdated, comment, followup,
       attributeoptioncomboid, created, deleted
from f_datavalue d where not exists (select 1 from sites s where s.sourceid = d.sourceid)
union all
select * from numeric union all select * from other union all select * from single
"""))
def merge_apply(spark, sf):
    """SNK1: the whole data value table after the SUM merge of f_merge_map (touched sites swapped)."""
    dv = fx.load(spark, sf, "f_datavalue")
    res = M.merge_values(dv, fx.load(spark, sf, "f_dataelement"), fx.load(spark, sf, "f_merge_map"), "SUM", RUN_TS)
    return M.replace_sites(dv, res.staged, res.sites, res.sites_small)


@query("merge_validate", """
, lookup AS (select uid, min(organisationunitid) as organisationunitid from f_orgunit group by uid)
select r.request_no, r.source_uid, r.dest_uid, r.strategy, s.organisationunitid as source_id, d.organisationunitid as dest_id,
       case when s.organisationunitid is null then 'Invalid source organisation unit'
            when d.organisationunitid is null then 'Invalid destination organisation unit'
            when r.source_uid = r.dest_uid then 'Cannot self-merge'
            when r.strategy is null or r.strategy not in ('SUM','MAX','MIN','AVG','LAST','FIRST')
                 then 'Please provide a merge strategy (SUM,MAX,MIN,AVG,LAST,FIRST)'
            when exists (select 1 from f_orgunit c where c.parentid = s.organisationunitid) then 'Organisationunit has children. Aborting.'
            when (select count(*) from f_merge_request x where x.source_uid = r.source_uid) > 1 then 'Source is merged more than once'
            when exists (select 1 from f_merge_request x where x.source_uid = r.dest_uid)
                 or exists (select 1 from f_merge_request x where x.dest_uid = r.source_uid) then 'Merge chain: a destination is also a source'
            when (select count(distinct strategy) from f_merge_request x where x.dest_uid = r.dest_uid) > 1
                 then 'Destination requested with different strategies'
       end as error
from f_merge_request r left join lookup s on r.source_uid = s.uid left join lookup d on r.dest_uid = d.uid
""", fixtures=("f_merge_request", "f_orgunit"))
def merge_validate(spark, sf):
    """MRG0: every merge request with the first failed check (NULL when valid)."""
    return M.validate_merges(fx.load(spark, sf, "f_merge_request"), fx.load(spark, sf, "f_orgunit"))


REQUESTED = """
, lookup AS (select uid, min(organisationunitid) as organisationunitid from f_orgunit group by uid)
, validated AS (
  select r.*, s.organisationunitid as source_id, d.organisationunitid as dest_id,
         case when s.organisationunitid is null then 'e1' when d.organisationunitid is null then 'e2'
              when r.source_uid = r.dest_uid then 'e3'
              when r.strategy is null or r.strategy not in ('SUM','MAX','MIN','AVG','LAST','FIRST') then 'e4'
              when exists (select 1 from f_orgunit c where c.parentid = s.organisationunitid) then 'e5'
              when (select count(*) from f_merge_request x where x.source_uid = r.source_uid) > 1 then 'e6'
              when exists (select 1 from f_merge_request x where x.source_uid = r.dest_uid)
                   or exists (select 1 from f_merge_request x where x.dest_uid = r.source_uid) then 'e7'
              when (select count(distinct strategy) from f_merge_request x where x.dest_uid = r.dest_uid) > 1 then 'e8'
         end as error
  from f_merge_request r left join lookup s on r.source_uid = s.uid left join lookup d on r.dest_uid = d.uid)
, mm AS (select source_id, dest_id, strategy from validated where error is null)
, sites AS (select source_id as sourceid, dest_id as dest from mm union select dest_id, dest_id from mm)
, ds AS (select dest_id as dest, min(strategy) as strat from mm group by dest_id)
""" + _shared("join ds on ds.dest = s.dest") + """, num_agg AS (select dataelementid, periodid, dest as sourceid, categoryoptioncomboid,
                     regexp_replace(regexp_replace(cast(cast(case strat
                        when 'SUM' then sum(cast(value as decimal(38,10)))
                        when 'AVG' then cast(avg(cast(value as decimal(38,10))) as decimal(38,10))
                        when 'MAX' then max(cast(value as decimal(38,10)))
                        when 'MIN' then min(cast(value as decimal(38,10))) end as decimal(38,10)) as varchar), '0+$', ''), '[.]$', '') as value,
                     'admin' as storedby, TIMESTAMP '{RUN_TS}' as lastupdated, cast(null as varchar) as comment, false as followup,
                     attributeoptioncomboid, TIMESTAMP '{RUN_TS}' as created, false as deleted
              from krows where n > 1 and is_num and strat in ('SUM', 'AVG', 'MAX', 'MIN')
              group by dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid, strat)
, num_rank AS (select distinct dataelementid, periodid, dest as sourceid, categoryoptioncomboid, value, storedby, lastupdated,
                      comment, followup, attributeoptioncomboid, created, deleted
               from (select *, case when strat = 'FIRST'
                                    then rank() over (partition by dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid
                                                      order by lastupdated asc nulls last)
                                    else rank() over (partition by dest, dataelementid, periodid, categoryoptioncomboid, attributeoptioncomboid
                                                      order by lastupdated desc nulls first) end as rnk
                     from krows where n > 1 and is_num and strat in ('FIRST', 'LAST')) t where rnk = 1)
""".replace("{RUN_TS}", RUN_TS)


@query("merge_requested", fx.with_clause(["f_merge_request", "f_orgunit", "f_datavalue", "f_dataelement"], fx.DUCKDB_TABLES)
       + REQUESTED + """
select * from num_agg union all select * from num_rank union all select * from other union all select * from single
""")
def merge_requested(spark, sf):
    """MRG0 + MRG1 (AGG8): uid merge requests validated, then every valid pair merged with
    its own strategy in one job (per-destination strategy column)."""
    ou = fx.load(spark, sf, "f_orgunit")
    valid = M.merge_map_of(M.validate_merges(fx.load(spark, sf, "f_merge_request"), ou))
    res = M.merge_values(fx.load(spark, sf, "f_datavalue"), fx.load(spark, sf, "f_dataelement"), valid, None, RUN_TS)
    return res.staged
