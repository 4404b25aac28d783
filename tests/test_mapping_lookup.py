"""Mapping, registry, lookup, similarity, store and streaming rules on micro-tables."""

from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from unitmesh.functions.jaro import jaro
from unitmesh.operators import lookup as L
from unitmesh.operators import mapping as MP
from unitmesh.operators import registry as R
from unitmesh.operators import similarity as SIM
from unitmesh.operators import store as ST
from unitmesh.sinks.writers import to_json_records, write_batches
from unitmesh.sources.files import read_directives
from unitmesh.sources.responses import from_headers_rows
from unitmesh.streaming.text_filter import run_line_filter


def test_rename_round_trip(spark):
    df = spark.createDataFrame([("ou", "de", "coc", "aoc", "5")],
                               "orgUnit string, dataElement string, categoryOptionCombo string, attributeOptionCombo string, value string")
    wh = MP.to_warehouse(df)
    assert wh.columns == ["location", "dataElement", "disaggregation", "attribution", "value"]
    assert rows(MP.from_warehouse(wh)) == rows(df)
    nested = spark.createDataFrame([([("L1", "A1")],)], "dataValues array<struct<locationId:string,attribution:string>>")
    back = MP.from_warehouse_payload(nested)
    assert back.schema["dataValues"].dataType.elementType.names == ["orgUnit", "attributeOptionCombo"]


def test_identifiers_need_id(spark):
    df = spark.createDataFrame([("a", "Alpha", None), (None, "Beta", "B"), ("c", "Gamma", "G")],
                               "id string, name string, code string")
    out = {r.name: r.identifier for r in MP.to_identifiers(df, "dataElements", "h", keep=["name"]).collect()}
    assert [x.property for x in out["Alpha"]] == ["id", "name"]
    assert out["Beta"] == []
    assert out["Gamma"][2].system == "h/api/dataElements/c?fields=id,code&filter=code:eq:G"


def test_payload_identifiers_need_the_resource(spark):
    payload = spark.createDataFrame([([("a", "Alpha"), ("b", None)],)],
                                    "dataElements array<struct<id:string,name:string>>")
    recs = MP.payload_identifiers(payload, "dataElements", "h").collect()
    assert sorted(len(r.identifier) for r in recs) == [1, 2]
    assert MP.payload_identifiers(payload, "organisationUnits", "h").count() == 0


def test_facility_empty_lists_pass_through(spark):
    units = spark.createDataFrame(
        [("u1", "Unit", "C", [], [])],
        "id string, name string, code string, ancestors array<struct<level:int,id:string,code:string,name:string>>, "
        "organisationUnitGroups array<struct<id:string,code:string,name:string>>")
    f = R.to_facility(units).first()
    assert f.ancestors == [] and f.organisationUnitGroups == []
    assert f.authority[0].type == "ownership" and len(f.authority) == 1
    assert [i.type for i in f.identifier] == ["code", "name", "id"] and f.identifier[0].value == ""


def test_enrich_keeps_all_documents(spark):
    docs = spark.createDataFrame([(1, ("A",)), (2, ("Z",))], "doc_id int, location struct<id:string>")
    units = spark.createDataFrame([("A", "/R/A")], "id string, path string")
    out = MP.enrich_location(docs, units)
    assert rows(out.select("doc_id", "location.path")) == [(1, "/R/A"), (2, None)]


def test_json_validity_python_rules(spark):
    df = spark.createDataFrame([("{\"a\": 1}",), ("NaN",), ("",), ("{\"a\":1}x",), (None,)], "t string")
    got = [r.v for r in df.select(L.is_valid_json(df.t).alias("v")).collect()]
    assert got == [True, True, False, False, False]


def test_jaro_values(spark):
    assert round(jaro("MARTHA", "MARHTA") * 100, 2) == 94.44
    assert jaro("abc", "abc") == 1.0 and jaro("", "") == 0.0
    pairs = spark.createDataFrame([(1, "MARTHA", "MARHTA"), (2, "x", "x")], "pair_id int, left_name string, right_name string")
    out = dict(rows(SIM.score_pairs(pairs), "pair_id", "matched"))
    assert out == {1: False, 2: True}


def test_find_filters(spark):
    df = spark.createDataFrame([(1, "click", '{"k": 5}'), (2, "view", '{"k": 60}'), (3, "click", '{"k": 70}')],
                               "id int, event_type string, props string")
    assert rows(L.find(df, '{"event_type": "click"}'), "id") == [(1,), (3,)]
    assert rows(L.find(df, '{"props.k": {"$gt": 10}, "event_type": {"$in": ["click"]}}'), "id") == [(3,)]
    assert L.find(df, None).count() == 3
    for bad in ("{bad", "[1]", '"x"'):
        with pytest.raises(ValueError):
            L.find(df, bad)
    odd = df.unionByName(spark.createDataFrame([(4, "click", '{"k": "high"}')], df.schema))
    assert rows(L.find(odd, '{"props.k": {"$gt": 10}}'), "id") == [(2,), (3,)]


def test_store_latest_and_update(spark):
    s = spark.createDataFrame([(1, '{"a": 1}', 1, 1), (1, '{"a": 2}', 2, 1), (2, '{"b": 3}', 1, 1)],
                              "key int, document string, ts int, seq int")
    assert rows(ST.kv_latest(s), "key", "document") == [(1, '{"a": 2}'), (2, '{"b": 3}')]
    upd = ST.kv_update(s, "a", "9", 3)
    assert rows(upd, "key", "document") == [(1, '{"a":9}'), (2, '{"a":9,"b":3}')]
    assert rows(ST.kv_latest(ST.kv_put(s, upd)), "key", "document") == [(1, '{"a":9}'), (2, '{"a":9,"b":3}')]
    odd = spark.createDataFrame([(5, "[1, 2]", 1, 1)], "key int, document string, ts int, seq int")
    assert rows(ST.kv_update(odd, "a", "9", 2), "document") == [("[1, 2]",)]


def test_headers_rows(spark):
    resp = spark.createDataFrame([([("dataelement",), ("shortname",)], [["A", "a"], ["B", "b"]])],
                                 "headers array<struct<name:string>>, rows array<array<string>>")
    assert rows(from_headers_rows(resp)) == [("A", "a"), ("B", "b")]
    assert from_headers_rows(resp, kind="AGGREGATE").columns == []


def test_directive_csv_and_batches(spark):
    d = tempfile.mkdtemp(prefix="unitmesh-test-")
    p = os.path.join(d, "dir.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("op,uid,name,parent,new,lat,lon,short,code\n")
        f.write(' add , X1 ,"Name, with comma",P,,1,2,,\n')
    df = read_directives(spark, p)
    r = df.first()
    assert (r.op, r.uid, r.name, r.lat, r.code) == ("add", "X1", "Name, with comma", "1", "")
    empty = df.limit(0)
    written = write_batches(df.selectExpr("uid as id", "name", "parent_uid as parent_id"), empty, empty, os.path.join(d, "out"))
    assert written == {"add": True, "edit": False, "relocate": False}
    rec = spark.read.json(os.path.join(d, "out", "add")).first()
    assert rec.parent.id == "P" and rec.attributeValues == []
    j = to_json_records(spark.createDataFrame([("a", None)], "x string, y string")).first().record
    assert j == '{"x":"a","y":null}'


def test_stream_filter_lines(spark):
    d = tempfile.mkdtemp(prefix="unitmesh-stream-")
    src = os.path.join(d, "src")
    spark.createDataFrame([(1, "spark here\nnothing\nspark again"), (2, "no match")], "doc_id long, text string") \
        .write.parquet(src)
    run_line_filter(spark, src, "doc_id long, text string", os.path.join(d, "out"), os.path.join(d, "ckpt"))
    out = spark.read.parquet(os.path.join(d, "out"))
    assert rows(out, "doc_id", "line_no") == [(1, 0), (1, 2)]


@pytest.mark.parametrize("prefix,expected", [("bl", [(1, "name")]), ("X", [(2, "code"), (2, "tags")])])
def test_code_search(spark, prefix, expected):
    df = spark.createDataFrame([(1, "Blue", "A1", ["z"]), (2, "red", "x9", ["xa", "b"])],
                               "id int, name string, code string, tags array<string>")
    assert rows(L.code_search(df, prefix, ["name", "code", "tags"], ["id"]), "id", "property") == expected


def test_store_append_and_read_table(spark):
    from unitmesh.sinks.writers import append, store
    from unitmesh.sources.files import read_resources, read_table

    d = tempfile.mkdtemp(prefix="unitmesh-sinks-")
    df = spark.createDataFrame([(1, "2020", "a"), (2, "2021", "b")], "id int, period string, v string")
    store(df, os.path.join(d, "wh"), partition_by=["period"], cluster_by=["id"])
    back = spark.read.parquet(os.path.join(d, "wh"))
    assert rows(back.where("period = '2021'"), "id") == [(2,)]
    append(df, os.path.join(d, "coll"))
    append(df, os.path.join(d, "coll"))
    assert read_table(spark, os.path.join(d, "coll"), "json").count() == 4
    assert read_table(spark, os.path.join(d, "coll"), "xml").count() == 0
    df.selectExpr("'Location' as resourceType", "id").write.json(os.path.join(d, "bundle"))
    assert read_resources(spark, os.path.join(d, "bundle"), "Location").count() == 2
    assert read_resources(spark, os.path.join(d, "bundle"), "metadata").count() == 0


def test_json_validity_jvm_path_differences(spark):
    df = spark.createDataFrame([("{\"a\": 1}",), ("NaN",), ("{\"a\":1}x",), ("",)], "t string")
    exact = [r.v for r in df.select(L.is_valid_json(df.t).alias("v")).collect()]
    fast = [r.v for r in df.select(L.is_valid_json(df.t, exact=False).alias("v")).collect()]
    assert exact == [True, True, False, False]
    # the JVM parser rejects NaN and accepts trailing text, as documented
    assert fast == [True, False, True, False]


def test_select_fields_and_extra_directive_columns(spark):
    df = spark.createDataFrame([("a", "Alpha", "C")], "id string, name string, code string")
    assert MP.select_fields(df, "dataElements", "id, name,missing").columns == ["id", "name", "missing"]
    assert MP.select_fields(df, "dataElements").columns == ["id", "name", "code", "valueType", "formName"]
    d = tempfile.mkdtemp(prefix="unitmesh-extra-")
    p = os.path.join(d, "dir.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("a,b,c,d,e,f,g,h,i,j\n")
        f.write("relocate,S1,,P,,,,,,note\n")
    r = read_directives(spark, p, extra_columns=1).first()
    assert (r.op, r.uid, r.parent_uid, r.col9) == ("relocate", "S1", "P", "note")


def test_find_truth_values_missing_values_and_nested_documents(spark):
    df = spark.createDataFrame([(1, '{"k": true, "n": {"m": 1}}', None), (2, '{"k": 57}', True), (3, None, False)], "id int, props string, b boolean")
    assert rows(L.find(df, '{"props.k": true}'), "id") == [(1,)]
    assert rows(L.find(df, '{"props": {"n": {"m": 1}}}'), "id") == [(1,)]
    assert rows(L.find(df, '{"b": null}'), "id") == [(1,)]
    assert rows(L.find(df, '{"b": {"$ne": true}}'), "id") == [(1,), (3,)]
    assert rows(L.find(df, '{"b": {"$in": [null, false]}}'), "id") == [(1,), (3,)]


def test_responses_keep_their_own_header_order(spark):
    from unitmesh.sources.responses import from_headers_rows
    df = spark.createDataFrame([([("name",), ("code",)], [["a", "1"]]), ([("code",), ("name",)], [["2", "b"]]), ([("name",)], [["c"]])],
                               "headers array<struct<name:string>>, rows array<array<string>>")
    assert rows(from_headers_rows(df), "name", "code") == [("a", "1"), ("b", "2"), ("c", None)]


def test_identifiers_follow_the_columns(spark):
    df = spark.createDataFrame([("n", "i", "c")], "name string, id string, code string")
    got = MP.to_identifiers(df, "dataElements", "h").first()["identifier"]
    assert [x["property"] for x in got] == ["name", "id", "code"]


def test_store_keeps_other_periods(spark, tmp_path):
    from unitmesh.sinks.writers import store
    path = str(tmp_path / "wh")
    df = spark.createDataFrame([("2020", "a", 1), ("2021", "b", 2)], "period string, location string, v int")
    store(df.where("period = '2020'"), path, ["period"], ["location"])
    store(df.where("period = '2021'"), path, ["period"], ["location"])
    store(df.where("period = '2021'").withColumn("v", F.lit(3)), path, ["period"], ["location"])
    assert rows(spark.read.parquet(path), "location", "v") == [("a", 1), ("b", 3)]


def test_update_of_documents_that_repeat_a_field(spark):
    s = spark.createDataFrame([(1, '{"x":1,"x":2}', 1, 1), (2, "[1]", 1, 1)], "key int, document string, ts int, seq int")
    assert rows(ST.kv_update(s, "a", "9", 2), "document") == [("[1]",), ('{"a":9,"x":2}',)]
    assert rows(ST.kv_unreadable(s), "key") == [(2,)]


def test_csv_cells_and_row_order(spark, tmp_path):
    from unitmesh.sources.files import read_directives
    one = tmp_path / "one.csv"
    one.write_text('op,uid,name,parent,new,lat,lon,short,code\nadd,U1,"Clinic ""A"", north\nwing",P,,,,,\nadd,U2,back\\,P,,,,,C\n')
    got = read_directives(spark, str(one)).orderBy("row_no").collect()
    assert [(r.uid, r.name, r.code) for r in got] == [("U1", 'Clinic "A", north\nwing', ""), ("U2", "back\\", "C")]
    (tmp_path / "two").mkdir()
    for n in "ab":
        (tmp_path / "two" / f"{n}.csv").write_text(one.read_text())
    with pytest.raises(ValueError):
        read_directives(spark, str(tmp_path / "two"))


def test_a_cluster_needs_a_checkpoint_folder():
    from types import SimpleNamespace

    from unitmesh.session import checkpoint_dir
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        checkpoint_dir(fake)
