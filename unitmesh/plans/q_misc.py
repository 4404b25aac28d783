"""Store (WIN5, SNK5-6), lookup (FIL7-9), similarity (UDF1, JON11), stream (STR1),
source/sink round trips (SRC1, SRC3, SRC5, SRC6, SNK2, SNK4, SNK8) and value scaling (UDF2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitmesh.operators import fuzzy as FZ
from unitmesh.operators import lookup as L
from unitmesh.operators import mapping as MP
from unitmesh.operators import similarity as SIM
from unitmesh.operators import store as ST
from unitmesh.plans import fixtures as fx
from unitmesh.plans.registry import RUN_TS, query
from unitmesh.session import scratch_path, table_path
from unitmesh.sinks.writers import to_json_records
from unitmesh.sources import files as SRC
from unitmesh.sources.responses import unwrap
from unitmesh.streaming.latest_store import apply_versions, create_store, read_store, run_latest_store
from unitmesh.streaming.text_filter import run_line_filter


def _store(spark, sf):
    ev = fx.raw(spark, sf, "events")
    return ev.select(F.col("user_id").alias("key"), F.col("props").alias("document"), "ts", F.col("event_id").alias("seq"))


_LATEST = """
, latest AS (select user_id as key, props as document, ts, event_id as seq
             from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) t
             where rn = 1)
"""


@query("kv_latest", "WITH x AS (select 1)" + _LATEST + "select * from latest")
def kv_latest(spark, sf):
    """WIN5 / SRC8: latest document per key of a versioned store (events: user_id, props)."""
    return ST.kv_latest(_store(spark, sf))


@query("kv_stream", "WITH x AS (select 1)" + _LATEST + "select * from latest")
def kv_stream(spark, sf):
    """SNK5 / WIN5 / REG2 as a stream: the events arrive in two loads, each taken in by a
    run of the stream; the first load is replayed at the end."""
    versions, schema = _store(spark, sf), "key bigint, document string, ts timestamp_ntz, seq bigint"
    versions = versions.select("key", "document", F.col("ts").cast("timestamp_ntz").alias("ts"), "seq")
    lo, hi = versions.agg(F.min("ts"), F.max("ts")).first()
    middle = F.lit(lo + (hi - lo) / 2).cast("timestamp_ntz")
    source, path, checkpoint = (scratch_path(spark, f"kv-stream-{n}") for n in ("source", "store", "checkpoint"))
    create_store(spark, path, schema)
    first = versions.where(F.col("ts") < middle)
    for load in (first, versions.where(~F.coalesce(F.col("ts") < middle, F.lit(False)))):
        load.write.mode("append").parquet(source)
        run_latest_store(spark, source, schema, path, checkpoint)
    apply_versions(first, path, schema)
    return read_store(spark, path, schema)


@query("kv_update", "WITH x AS (select 1)" + _LATEST + f"""
select key, cast(json_merge_patch(document, '{{"seen":true}}') as varchar) as document,
       TIMESTAMP '{RUN_TS}' as ts, cast(0 as bigint) as seq from latest
""")
def kv_update(spark, sf):
    """SNK6: for every key the latest document with field ``seen`` set, as new versions."""
    return ST.kv_update(_store(spark, sf), "seen", "true", RUN_TS)


@query("kv_put", "WITH x AS (select 1)" + _LATEST + f"""
select key, case when key % 3 = 0 then '{{"replaced":true}}' else document end as document,
       case when key % 3 = 0 then TIMESTAMP '{RUN_TS}' else ts end as ts, case when key % 3 = 0 then cast(1 as bigint) else seq end as seq
from latest
""")
def kv_put(spark, sf):
    """SNK5: a new document saved under every third key; the latest version of every key."""
    store = _store(spark, sf)
    items = (store.where(F.col("key") % 3 == 0).select("key").distinct()
             .select("key", F.lit('{"replaced":true}').alias("document"), F.lit(RUN_TS).cast(store.schema["ts"].dataType).alias("ts"),
                     F.lit(1).cast("long").alias("seq")))
    return ST.kv_latest(ST.kv_put(store, items))


FIND_FILTER = '{"event_type": "click", "props.k": {"$gte": 50}}'


@query("find", """
select * from events where event_type = 'click' and cast(json_extract_string(props, '$.k') as double) >= 50
""")
def find(spark, sf):
    """FIL7: documents matching a JSON filter (equality, nested path into JSON text, $gte)."""
    return L.find(fx.raw(spark, sf, "events"), FIND_FILTER)


@query("find_null_bool", fx.oracle("""
select * from f_datavalue
where followup and lastupdated is null and storedby <> 'F' and (dataelementid in (3, 5) or dataelementid is null) and categoryoptioncomboid is not null
""", ["f_datavalue"]))
def find_null_bool(spark, sf):
    """FIL7: truth values, missing values, $ne (also of null), and $in with null."""
    return L.find(fx.load(spark, sf, "f_datavalue"), """{"followup": true, "lastupdated": null, "storedby": {"$ne": "F"},
        "dataelementid": {"$in": [3, 5, null]}, "categoryoptioncomboid": {"$ne": null}}""")


@query("find_nested", """
select event_id, props from events where cast(json_extract_string(props, '$.k') as double) = 57
""")
def find_nested(spark, sf):
    """FIL7: a nested document as filter, against JSON text."""
    return L.find(fx.raw(spark, sf, "events"), '{"props": {"k": 57}}').select("event_id", "props")


@query("find_array_missing", fx.oracle("""
select id, name, code, parent_id, array_to_string(attributeValues, ',') as attribute_values from f_snapshot
where (list_contains(attributeValues, 'a1004') or list_contains(attributeValues, 'a102') or list_contains(attributeValues, 'a1010'))
union all
select id, name, code, parent_id, array_to_string(attributeValues, ',') from f_snapshot where list_contains(attributeValues, 'b') and parent_id is null
""", ["f_snapshot"]))
def find_array_missing(spark, sf):
    """FIL7: a scalar matches an element of an array; null matches a field that does not exist."""
    s = fx.load(spark, sf, "f_snapshot")
    found = (L.find(s, '{"attributeValues": {"$in": ["a1004", "a102", "a1010"]}, "closedDate": null, "contact.phone": {"$ne": 1}}')
             .unionByName(L.find(s, '{"attributeValues": "b", "parent_id": null, "nothing": {"$in": [null]}}'))
             .unionByName(L.find(s, '{"nothing": "b"}')))
    return found.select("id", "name", "code", "parent_id", F.array_join("attributeValues", ",").alias("attribute_values"))


@query("trimmed_titles", r"""
select doc_id, regexp_replace(t, '^[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+|[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+$', '', 'g') as title
from (select doc_id, chr(12288) || chr(9) || substr(text, 1, 24) || chr(160) || chr(8195) as t from documents)
""")
def trimmed_titles(spark, sf):
    """SCL1: white space of every kind taken off both ends."""
    t = F.concat(F.lit("\u3000\t"), F.substring("text", 1, 24), F.lit("\u00a0\u2003"))
    return fx.raw(spark, sf, "documents").select("doc_id", SRC.trim_all(t).alias("title"))


@query("json_valid", """
select 'events' as source, event_id as id, json_valid(props) as valid from events
union all select 'documents', doc_id, json_valid(text) from documents
union all select 'pages', page_id, json_valid(html) from pages
union all select 'benchmark', item_id, json_valid(text) from benchmark
union all select 'conversations', conv_id * 1000 + turn, json_valid(text) from conversations
""")
def json_valid(spark, sf):
    """FIL8: JSON validity (Python json.loads rules) of event props and of free texts."""
    parts = [
        fx.raw(spark, sf, "events").select(F.lit("events").alias("source"), F.col("event_id").alias("id"), F.col("props").alias("t")),
        fx.raw(spark, sf, "documents").select(F.lit("documents"), F.col("doc_id"), F.col("text")),
        fx.raw(spark, sf, "pages").select(F.lit("pages"), F.col("page_id"), F.col("html")),
        fx.raw(spark, sf, "benchmark").select(F.lit("benchmark"), F.col("item_id"), F.col("text")),
        fx.raw(spark, sf, "conversations").select(F.lit("conversations"), F.col("conv_id") * 1000 + F.col("turn"), F.col("text")),
    ]
    u = parts[0]
    for p in parts[1:]:
        u = u.union(p)
    return u.select("source", "id", L.is_valid_json(F.col("t")).alias("valid"))


@query("code_search", """
select p_partkey, 'p_name' as property, p_name as value from part where starts_with(lower(p_name), 'brand#1')
union all select p_partkey, 'p_brand', p_brand from part where starts_with(lower(p_brand), 'brand#1')
union all select p_partkey, 'p_type', p_type from part where starts_with(lower(p_type), 'brand#1')
""")
def code_search(spark, sf):
    """FIL9: code-prefix search over several properties, flat results."""
    return L.code_search(fx.raw(spark, sf, "part"), "Brand#1", ["p_name", "p_brand", "p_type"], ["p_partkey"])


@query("code_search_index", """
select p_partkey, 'p_name' as property, p_name as value from part where starts_with(lower(p_name), 're')
union all select p_partkey, 'p_brand', p_brand from part where starts_with(lower(p_brand), 're')
union all select p_partkey, 'p_type', p_type from part where starts_with(lower(p_type), 're')
""")
def code_search_index(spark, sf):
    """FIL9 on a stored prefix index of several properties: a range filter on its scan."""
    path = scratch_path(spark, "prefix-index")
    L.prefix_index(fx.raw(spark, sf, "part"), ["p_name", "p_brand", "p_type"], ["p_partkey"]).write.parquet(path)
    return L.prefix_search(spark.read.parquet(path), "RE")


@query("code_search_lists", """
select p_partkey, 'names' as property, v as value
from (select p_partkey, unnest([p_name, p_brand, lower(p_brand), p_type]) as v from part) t where starts_with(lower(v), 'brand#1')
""")
def code_search_lists(spark, sf):
    """FIL9 on a list property: one row per element that starts with the prefix."""
    part = fx.raw(spark, sf, "part").select("p_partkey", F.array("p_name", "p_brand", F.lower("p_brand"), "p_type").alias("names"))
    return L.code_search(part, "Brand#1", ["names"], ["p_partkey"])


@query("name_similarity", fx.oracle("""
select pair_id, left_name, right_name, round(jaro_similarity(left_name, right_name) * 100, 6) as match_value,
       round(jaro_similarity(left_name, right_name) * 100, 6) = 100 as matched
from f_name_pair
""", ["f_name_pair"]))
def name_similarity(spark, sf):
    """UDF1 / SCL13: Jaro similarity x 100 of name pairs; matched only at 100."""
    return SIM.score_pairs(fx.load(spark, sf, "f_name_pair"))


@query("name_match", fx.oracle("""
, reps AS (select name, min(id) as matched_id, count(*) as n_same_name from f_term_stored group by name)
select i.id, i.dataelement, i.shortname, r.matched_id, coalesce(r.n_same_name, 0) as n_same_name,
       r.matched_id is not null as matched
from f_term_incoming i left join reps r on i.dataelement = r.name
""", ["f_term_incoming", "f_term_stored"]))
def name_match(spark, sf):
    """JON11 (re-aimed): incoming names matched exactly to stored names, one partner each."""
    stored = fx.load(spark, sf, "f_term_stored")
    return SIM.match_names(fx.load(spark, sf, "f_term_incoming"), stored, "dataelement", "name", "id")


@query("name_fuzzy", fx.oracle("""
, pairs AS (select l.name as ln, r.name as rn, round(jaro_similarity(l.name, r.name) * 100, 6) as v
            from (select distinct dataelement as name from f_term_incoming) l, (select distinct name from f_term_stored) r)
, best AS (select ln, rn, v, count(*) over (partition by ln) as n_similar, row_number() over (partition by ln order by v desc, rn) as k
           from pairs where v >= 80)
, ids AS (select name, min(id) as matched_id from f_term_stored group by name)
select i.id, i.dataelement, i.shortname, b.rn as matched_name, ids.matched_id, b.v as match_value,
       coalesce(b.n_similar, 0) as n_similar, coalesce(b.v = 100, false) as matched
from f_term_incoming i left join best b on b.ln = i.dataelement and b.k = 1 left join ids on ids.name = b.rn
""", ["f_term_incoming", "f_term_stored"]))
def name_fuzzy(spark, sf):
    """JON11 / UDF1: incoming names with the most similar stored name at 80 or above."""
    return FZ.fuzzy_matches(fx.load(spark, sf, "f_term_incoming"), fx.load(spark, sf, "f_term_stored"), "dataelement", "name", "id", 80.0)


@query("name_fuzzy_titles", fx.oracle("""
select * from (
  select l.title as left_name, r.title as right_name, round(jaro_similarity(l.title, r.title) * 100, 6) as match_value
  from (select distinct title from f_title where side = 0) l, (select distinct title from f_title where side = 1) r) p
where match_value >= 90
""", ["f_title"]))
def name_fuzzy_titles(spark, sf):
    """JON11: all pairs of a document title and a conversation title of similarity 90 or above."""
    t = fx.load(spark, sf, "f_title")
    return FZ.fuzzy_pairs(t.where("side = 0"), t.where("side = 1"), "title", "title", 90.0)


def _stream(spark, sf, keyword):
    out = scratch_path(spark, "stream-out")
    # a glob that only this path matches: the stream source takes folders or globs
    run_line_filter(spark, table_path(sf, "documents")[:-1] + "[t]",
                    "doc_id bigint, text string", out, scratch_path(spark, "stream-ckpt"), keyword=keyword)
    return spark.read.parquet(out)


_LINES = """
select doc_id, cast(line_no as int) as line_no, line from (
  select doc_id, unnest(string_split(text, chr(10))) as line, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) as line_no
  from documents) t
"""


@query("stream_filter", _LINES + " where contains(line, 'spark')")
def stream_filter(spark, sf):
    """STR1: streamed document lines containing 'spark' (the reference's keyword)."""
    return _stream(spark, sf, "spark")


@query("stream_filter_common", _LINES + " where contains(line, 'the')")
def stream_filter_common(spark, sf):
    """STR1 with a keyword that occurs often ('the'), so the stream carries rows."""
    return _stream(spark, sf, "the")


@query("directives_csv", fx.oracle("select * from f_directive", ["f_directive"]))
def directives_csv(spark, sf):
    """SRC1: directives written as positional CSV files (quotes, commas, line breaks and
    backslashes in cells) and read back (trimmed cells, row_no)."""
    d = fx.load(spark, sf, "f_directive")
    path = scratch_path(spark, "directives-csv")
    cols = ["op", "uid", "name", "parent_uid", "new_name", "lat", "lon", "shortname", "code", "parent_code", "row_no"]
    (d.select(*[F.concat(F.lit(" "), F.col(c).cast("string")) if c in ("op", "name") else F.col(c) for c in cols])
     .toDF(*cols).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    r = SRC.read_directives(spark, path, extra_columns=1)
    return r.withColumnRenamed("col9", "parent_code").select(*cols)


@query("unwrap_pages", fx.oracle("""
select id, name, shortName, code, parent_id, openingDate, featureType, coordinates, created from f_snapshot
""", ["f_snapshot"]))
def unwrap_pages(spark, sf):
    """SRC3 + SRC5: paged {pager, organisationUnits} JSON read with an inferred schema and unwrapped."""
    s = fx.load(spark, sf, "f_snapshot")
    cols = ["id", "name", "shortName", "code", "parent_id", "openingDate", "featureType", "coordinates", "created"]
    pages = (s.groupBy((F.col("row_no") / 50).cast("long").alias("page"))
             .agg(F.collect_list(F.struct(*cols)).alias("organisationUnits"), F.count(F.lit(1)).alias("n"))
             .select(F.struct(F.col("page"), F.col("n").alias("pageSize")).alias("pager"), "organisationUnits"))
    path = scratch_path(spark, "pages-json")
    pages.write.json(path)
    recs = unwrap(SRC.read_json(spark, path))
    return recs.select(*[F.col(c) if c in recs.columns else F.lit(None).cast("string").alias(c) for c in cols])


@query("resources", fx.oracle("""
select id, name from f_snapshot where id is not null
""", ["f_snapshot"]))
def resources(spark, sf):
    """SRC6: resources of one type ('Location') from an exported NDJSON bundle of mixed types."""
    s = fx.load(spark, sf, "f_snapshot").select(F.lit("Location").alias("resourceType"), "id", "name")
    e = fx.load(spark, sf, "f_element_meta").select(F.lit("DataElement").alias("resourceType"), "id", "name")
    path = scratch_path(spark, "bundle-ndjson")
    s.unionByName(e).write.json(path)
    return SRC.read_resources(spark, path, "Location").select("id", "name")


@query("json_records", fx.oracle("""
select to_json(struct_pack(location := orgUnit, dataElement := dataElement, period := period,
                           disaggregation := categoryOptionCombo, attribution := attributeOptionCombo,
                           value := value, storedby := storedby, comment := comment, followup := followup))::varchar as record
from f_payload
""", ["f_payload"]))
def json_records(spark, sf):
    """SNK8: warehouse records serialised as JSON objects, NULL fields kept."""
    return to_json_records(MP.to_warehouse(fx.load(spark, sf, "f_payload")))


@query("scaled_values", fx.oracle("""
select v.dataelementid, v.periodid, v.sourceid, v.categoryoptioncomboid, v.attributeoptioncomboid, v.value, v.storedby,
       v.lastupdated, v.comment, v.followup, v.created, v.deleted,
       regexp_replace(regexp_replace(cast(cast(try_cast(v.value as decimal(38,10)) * cast(p.p_size as decimal(18,6)) as decimal(38,10)) as varchar),
                      '0+$', ''), '[.]$', '') as scaled
from f_datavalue v left join part p on p.p_partkey = v.dataelementid
""", ["f_datavalue"]))
def scaled_values(spark, sf):
    """UDF2: every value multiplied by its element's factor (part size) through a checked broadcast join (text has no product)."""
    factors = fx.raw(spark, sf, "part").select(F.col("p_partkey").cast("int").alias("dataelementid"),
                                               F.col("p_size").alias("factor"))
    return MP.scale_values(fx.load(spark, sf, "f_datavalue"), factors, cast_mode="try")


def _site_batches(spark, sf):
    from unitmesh.operators import sites as S
    from unitmesh.plans.registry import TODAY

    d, snap = fx.load(spark, sf, "f_directive"), fx.load(spark, sf, "f_snapshot")
    adds, _ = S.site_adds(d, snap)
    upd = S.site_updates(d, snap, TODAY)
    return adds, upd.edits, upd.relocates


def _sites_sql(tail: str) -> str:
    from unitmesh.plans.q_sites import _sql

    return _sql(tail)


_BATCH = "name, shortName, code, parent_id, openingDate, featureType, coordinates"


@query("batches_json", _sites_sql(f"""
select 'add' as batch, id, {_BATCH}, cast(null as varchar) as created, cast(null as varchar) as contact, cast([] as varchar[]) as attributeValues from adds
union all select 'edit', id, {_BATCH}, created, contact, attributeValues from st where has_edit
union all select 'relocate', id, {_BATCH}, created, contact, attributeValues from st where has_relocate
"""))
def batches_json(spark, sf):
    """SNK2: add, edit and relocation batches written as NDJSON (each only if non-empty)
    and read back: one row per written site with its batch and every field."""
    from unitmesh.sinks.writers import write_batches

    out = scratch_path(spark, "batches")
    adds, edits, relocates = _site_batches(spark, sf)
    written = write_batches(adds, edits, relocates, out)
    fields = _BATCH.replace("parent_id, ", "").split(", ") + ["created", "contact"]
    schema = "id string, parent struct<id:string>, attributeValues array<string>, " + ", ".join(f"{f} string" for f in fields)
    res = None
    for b, ok in written.items():
        if ok:
            part = spark.read.schema(schema).json(f"{out}/{b}").select(
                F.lit(b).alias("batch"), "id", F.col("parent.id").alias("parent_id"), "attributeValues", *fields)
            res = part if res is None else res.unionByName(part)
    if res is None:
        return spark.createDataFrame([], "batch string, parent_id string, " + schema).drop("parent")
    return res


@query("warehouse_store", fx.oracle("""
select orgUnit as location, dataElement, categoryOptionCombo as disaggregation, attributeOptionCombo as attribution,
       value, storedby, comment, followup, period
from f_payload
""", ["f_payload"]))
def warehouse_store(spark, sf):
    """SNK4: warehouse records stored as parquet partitioned by period and clustered by
    location, in two stores (one year, then the others, which leave it alone), read back."""
    from unitmesh.sinks.writers import store

    path = scratch_path(spark, "warehouse")
    wh = MP.to_warehouse(fx.load(spark, sf, "f_payload"))
    store(wh.where("period = '1995'"), path, partition_by=["period"], cluster_by=["location"])
    store(wh.where("period <> '1995'"), path, partition_by=["period"], cluster_by=["location"])
    return SRC.read_store(spark, path, wh.schema)


@query("documents_append", fx.oracle("""
select doc_id, location_id, status, amount from f_location_doc
union all
select doc_id, location_id, status, amount from f_location_doc where status = 'F'
""", ["f_location_doc"]))
def documents_append(spark, sf):
    """SNK7 + SRC2: documents appended to a collection folder in two writes (all, then the
    finished ones again), read back as a json table."""
    from unitmesh.sinks.writers import append

    docs = fx.load(spark, sf, "f_location_doc")
    path = scratch_path(spark, "collection")
    append(docs, path)
    append(docs.where(F.col("status") == "F"), path)
    back = SRC.read_table(spark, path, "json")
    return back.select(F.col("doc_id").cast("bigint"), "location_id", "status", F.col("amount").cast("double"))


@query("documents_csv", fx.oracle("select cast(row_no as varchar) as row_no, name, new_name from f_directive", ["f_directive"]))
def documents_csv(spark, sf):
    """SRC2: a csv table (quotes, commas, line breaks and backslashes in cells) with its header's names."""
    path = scratch_path(spark, "table-csv")
    (fx.load(spark, sf, "f_directive").select("row_no", "name", "new_name")
     .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path))
    back = SRC.read_table(spark, path, "csv")
    return back.select("row_no", *[F.coalesce(c, F.lit("")).alias(c) for c in ("name", "new_name")])
