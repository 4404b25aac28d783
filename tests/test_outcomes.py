"""Outcomes at the edges: JSON validity, finds on missing fields and arrays, responses
whose headers differ, white space of every kind, the order of a sorted export."""

from __future__ import annotations

import json
import sys

import pytest
from pyspark.sql import functions as F

from unitmesh.operators import lookup as L
from unitmesh.operators.registry import to_facility
from unitmesh.sources.files import trim_all
from unitmesh.sources.responses import from_headers_rows, header_names

TEXTS = ["[" * 200_000, "[" * 200_000 + "]" * 200_000, "1" * 5000, "-" + "9" * 5000, "1." + "2" * 5000, "1" * 4300, "NaN", "-Infinity", " null ", "tru", "", " ", "01", "-",
         "1e5", "1E+", "-0.5e-3", '"a"', '"a', '"a\\"', '"a\\u00e9"', '"a\nb"', '"é"', "[1,2]", "[1,]", "{}", '{"a":NaN}', '{"a":1}{', "{} {}", "﻿1", "1　", "nul", "\n[]\t",
         '{"a":' * 3000 + "1" + "}" * 3000, "'a'", "[1]x", None, "Infinity", "+1", ".5", "1.", "--1"]


def plain(t):
    if t is None:
        return False
    try:
        json.loads(t)
    except (ValueError, RecursionError):
        return False
    return True


def test_json_validity_of_every_kind_of_text(spark):
    got = [r.v for r in spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string").select("k", L.is_valid_json(F.col("t")).alias("v")).orderBy("k").collect()]
    assert got == [plain(t) for t in TEXTS]
    at = dict(zip(TEXTS, got))
    assert not at["[" * 200_000] and not at["[" * 200_000 + "]" * 200_000] and at["NaN"]
    assert at["1" * 4300] and at["1" * 5000] == (sys.get_int_max_str_digits() == 0)


def test_scalars_never_reach_python(spark, monkeypatch):
    seen = F.when(F.lit(True), F.col("t"))
    monkeypatch.setattr(L, "_json_loads_ok", lambda c: F.when(c.isNotNull(), F.raise_error(F.lit("sent"))).cast("boolean"))
    df = spark.createDataFrame([(t,) for t in ("1", "NaN", "plain text", '"a"', "", "true", "[1", "{x")], "t string")
    assert [r.v for r in df.select(L.is_valid_json(seen).alias("v")).collect()] == [True, True, False, True, False, True, False, False]


DOCS = [(1, ["x", "y"], "a", [{"n": 1}, {"n": 5}], {"k": 2}, '{"p": 3}'), (2, ["z"], None, [], {"k": None}, "{}"), (3, None, "x", None, None, None), (4, ["x", None], "b", [{"n": 9}], {"k": 7}, '{"p": "x"}')]
SCHEMA = "id int, tags array<string>, name string, items array<struct<n:int>>, s struct<k:int>, j string"


@pytest.mark.parametrize("flt,ids", [
    ({"missing": None}, [1, 2, 3, 4]), ({"missing": 1}, []), ({"missing": {"$ne": 1}}, [1, 2, 3, 4]), ({"missing": {"$gt": 1}}, []), ({"missing": {"$in": [None, 2]}}, [1, 2, 3, 4]),
    ({"s.none": None}, [1, 2, 3, 4]), ({"s.none": "a"}, []), ({"name.deep": "a"}, []), ({"missing.deep": True}, []), ({"s": {"none": None, "k": 2}}, [1]),
    ({"tags": "x"}, [1, 4]), ({"tags": {"$ne": "x"}}, [2, 3]), ({"tags": None}, [3, 4]), ({"tags": ["x", "y"]}, [1]), ({"tags": ["x", None]}, [4]), ({"tags": 5}, []),
    ({"items.n": 5}, [1]), ({"items.n": {"$gte": 5}}, [1, 4]), ({"items.none": None}, [1, 2, 3, 4]), ({"items": "x"}, []), ({"s": "x"}, []), ({"s": True}, []),
    ({"j.p": 3}, [1]), ({"j.p": "x"}, [4]), ({"name": "a", "tags": {"$in": ["y", "q"]}}, [1]), ({"name": ["a"]}, [])])
def test_find_on_missing_fields_and_arrays(spark, flt, ids):
    df = spark.createDataFrame(DOCS, SCHEMA)
    assert sorted(r.id for r in L.find(df, json.dumps(flt)).collect()) == ids


def test_headers_of_all_responses(spark):
    df = spark.createDataFrame([([{"name": "a"}, {"name": "c"}], [["1", "2"]]), ([{"name": "b"}, {"name": "a"}], [["3", "4"], ["5", "6"]]), (None, [["7"]]), ([], [])],
                               "headers array<struct<name:string>>, rows array<array<string>>").coalesce(1)
    assert header_names(df) == ["a", "c", "b"]
    assert sorted((tuple(r) for r in from_headers_rows(df).collect()), key=str) == [("1", "2", None), ("4", None, "3"), ("6", None, "5"), (None, None, None)]


def test_white_space_of_every_kind(spark):
    spaces = "".join(chr(c) for c in range(0x3100) if chr(c).isspace())
    texts = [spaces + "a" + spaces + "b" + spaces, "​x​", spaces, "　x", "x\n", ""]
    got = [r.t for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", trim_all(F.col("t")).alias("t")).orderBy("k").collect()]
    assert got == [t.strip() for t in texts]


def test_sorted_export_keeps_its_order_on_disk(spark, tmp_path):
    units = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("id"), F.lit("n").alias("name"), F.array().cast(
        "array<struct<level:int,id:string,code:string,name:string>>").alias("ancestors"), F.array().cast("array<struct<id:string,code:string,name:string>>").alias("organisationUnitGroups"))
    to_facility(units.repartition(7), sort=True).select("id").write.text(str(tmp_path / "out"))
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().split()]
    assert len(lines) == 500 and lines == sorted(lines)
