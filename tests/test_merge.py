"""Hand-made micro-tables for the merge rules (MRG0, MRG1, SNK1)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from unitmesh.operators import merge as M
from unitmesh.schemas import DATAELEMENT, DATAVALUE, ORGUNIT

RUN_TS = "2024-06-30 12:00:00"
NOW = dt.datetime(2024, 6, 30, 12, 0, 0)
T1 = dt.datetime(2020, 1, 1)
T2 = dt.datetime(2021, 1, 1)

# sites: 10 = destination, 11 = source; element 1 numeric, 2 text, 3 untyped, 4 unknown
ELEMENTS = [(1, "INTEGER"), (2, "TEXT"), (3, None)]


def dv(de, site, value, ts, coc=1, deleted=False, comment=None):
    return (de, 2020, site, coc, value, "u", ts, comment, False, 1, ts, deleted)


def run(spark, values, strategy, cast_mode="ansi"):
    d = spark.createDataFrame(values, DATAVALUE)
    e = spark.createDataFrame(ELEMENTS, DATAELEMENT)
    m = spark.createDataFrame([(11, 10)], "source_id int, dest_id int")
    return M.merge_values(d, e, m, strategy, RUN_TS, cast_mode), d


def test_sum_decimal_text_and_numeric_max(spark):
    res, _ = run(spark, [dv(1, 10, "1.50", T1), dv(1, 11, "2", T2)], "SUM")
    assert rows(res.staged, "sourceid", "value", "storedby", "lastupdated") == [(10, "3.5", "admin", NOW)]
    res, _ = run(spark, [dv(1, 10, "9", T1), dv(1, 11, "10", T2)], "MAX")
    assert rows(res.staged, "value") == [("10",)]
    res, _ = run(spark, [dv(1, 10, "1", T1), dv(1, 11, "2", T2)], "AVG")
    assert rows(res.staged, "value") == [("1.5",)]


def test_non_numeric_text_fails_under_sum_unless_try(spark):
    res, _ = run(spark, [dv(1, 10, "abc", T1), dv(1, 11, "2", T2)], "SUM")
    with pytest.raises(Exception):
        res.staged.collect()
    res, _ = run(spark, [dv(1, 10, "abc", T1), dv(1, 11, "2", T2)], "SUM", cast_mode="try")
    assert rows(res.staged, "value") == [("2",)]


def test_null_key_is_lost(spark):
    res, _ = run(spark, [dv(1, 10, "1", T1), dv(1, 11, "2", T2, coc=None)], "SUM")
    assert rows(res.staged, "value", "lastupdated") == [("1", NOW)]
    assert rows(res.lost, "reason") == [("null key",)]


def test_first_last_ties(spark):
    # identical tied rows collapse, differing tied rows stay
    same = [dv(1, 10, "5", T1), dv(1, 11, "5", T1)]
    res, _ = run(spark, same, "FIRST")
    assert rows(res.staged, "sourceid", "value", "lastupdated") == [(10, "5", T1)]
    differ = [dv(1, 10, "5", T2), dv(1, 11, "6", T2), dv(1, 11, "7", T1, coc=1)]
    res, _ = run(spark, differ[:2], "LAST")
    assert rows(res.staged, "value") == [("5",), ("6",)]


def test_null_lastupdated_wins_last_loses_first(spark):
    vals = [dv(1, 10, "5", None), dv(1, 11, "6", T1)]
    res, _ = run(spark, vals, "LAST")
    assert rows(res.staged, "value") == [("5",)]
    res, _ = run(spark, vals, "FIRST")
    assert rows(res.staged, "value") == [("6",)]


def test_other_types_latest_then_smaller_original_source(spark):
    res, _ = run(spark, [dv(2, 10, "a", T1), dv(2, 11, "b", T2)], "SUM")
    assert rows(res.staged, "sourceid", "value", "lastupdated") == [(10, "b", NOW)]
    res, _ = run(spark, [dv(2, 10, "a", T2), dv(2, 11, "b", T2)], "SUM")
    assert rows(res.staged, "value") == [("a",)]


def test_singletons_of_any_type_move(spark):
    res, _ = run(spark, [dv(2, 11, "txt", T1), dv(4, 11, "x", T1, coc=2)], "SUM")
    assert rows(res.staged, "dataelementid", "sourceid", "lastupdated") == [(2, 10, NOW), (4, 10, NOW)]


def test_untyped_overlaps_are_lost(spark):
    res, _ = run(spark, [dv(3, 10, "1", T1), dv(3, 11, "2", T2)], "SUM")
    assert res.staged.count() == 0
    assert rows(res.lost, "reason") == [("no value type",), ("no value type",)]


def test_swap_drops_tombstones_and_keeps_other_sites(spark):
    vals = [dv(1, 10, "1", T1), dv(1, 11, "2", T2), dv(1, 10, "9", T1, coc=5, deleted=True),
            dv(1, 11, "9", T1, coc=6, deleted=None), dv(1, 12, "7", T1)]
    res, base = run(spark, vals, "SUM")
    out = M.replace_sites(base, res.staged, res.sites)
    assert rows(out, "sourceid", "categoryoptioncomboid", "value") == [(10, 1, "3"), (12, 1, "7")]


def test_sum_preserves_total(spark):
    vals = [dv(1, 10 + (i % 2), str(i), T1, coc=i // 2) for i in range(40)]
    res, _ = run(spark, vals, "SUM")
    total = res.staged.select(F.sum(F.col("value").cast("decimal(38,10)"))).first()[0]
    assert int(total) == sum(range(40))


def test_validation_order(spark):
    ou = spark.createDataFrame([(1, "A", None), (2, "B", 1), (3, "C", None), (4, "D", None), (5, "E", None)], ORGUNIT)
    req = spark.createDataFrame([
        ("Z", "B", "SUM"),   # unknown source
        ("B", "Z", "SUM"),   # unknown destination
        ("C", "C", "SUM"),   # self
        ("C", "D", "sum"),   # strategy is case-sensitive
        ("A", "C", "SUM"),   # A has a child
        ("D", "E", "MAX"),   # E is a destination...
        ("E", "B", "MAX"),   # ...and a source here: chain
    ], "source_uid string, dest_uid string, strategy string")
    out = {(r.source_uid, r.dest_uid): r.error for r in M.validate_merges(req, ou).collect()}
    assert out[("Z", "B")] == M.ERR_SOURCE
    assert out[("B", "Z")] == M.ERR_DEST
    assert out[("C", "C")] == M.ERR_SELF
    assert out[("C", "D")] == M.ERR_STRATEGY
    assert out[("A", "C")] == M.ERR_CHILDREN
    assert out[("D", "E")] == M.ERR_CHAIN
    assert out[("E", "B")] == M.ERR_CHAIN


def test_per_destination_strategies(spark):
    # 11 -> 10 with SUM, 21 -> 20 with LAST, in one job
    d = spark.createDataFrame([dv(1, 10, "1", T1), dv(1, 11, "2", T2), dv(1, 20, "5", T1), dv(1, 21, "6", T2)], DATAVALUE)
    e = spark.createDataFrame(ELEMENTS, DATAELEMENT)
    m = spark.createDataFrame([(11, 10, "SUM"), (21, 20, "LAST")], "source_id int, dest_id int, strategy string")
    res = M.merge_values(d, e, m, None, RUN_TS)
    assert rows(res.staged, "sourceid", "value") == [(10, "3"), (20, "6")]


def test_repeated_source_and_mixed_strategies(spark):
    ou = spark.createDataFrame([(i, u, None) for i, u in enumerate("ABCDEFG", 1)], ORGUNIT)
    req = spark.createDataFrame([("A", "B", "SUM"), ("A", "C", "SUM"), ("D", "F", "SUM"), ("E", "F", "MAX")],
                                "source_uid string, dest_uid string, strategy string")
    out = {(r.source_uid, r.dest_uid): r.error for r in M.validate_merges(req, ou).collect()}
    assert out[("A", "B")] == out[("A", "C")] == M.ERR_REPEATED
    assert out[("D", "F")] == out[("E", "F")] == M.ERR_MIXED
    assert M.merge_map_of(M.validate_merges(req, ou)).count() == 0


def test_hot_key_many_sources_one_destination(spark):
    # 400 sources merged into site 10, all reporting the same key: one hot group
    srcs = list(range(100, 500))
    vals = [dv(1, s, str(s), dt.datetime(2020, 1, 1) + dt.timedelta(days=s)) for s in srcs]
    vals += [dv(2, s, f"t{s}", dt.datetime(2020, 1, 1) + dt.timedelta(days=s % 7)) for s in srcs]
    d = spark.createDataFrame(vals, DATAVALUE)
    e = spark.createDataFrame(ELEMENTS, DATAELEMENT)
    m = spark.createDataFrame([(s, 10) for s in srcs], "source_id int, dest_id int")
    res = M.merge_values(d, e, m, "SUM", RUN_TS)
    got = {r.dataelementid: r.value for r in res.staged.collect()}
    assert got[1] == str(sum(srcs))
    # text element: latest day-of-week 6, smallest original source among those
    assert got[2] == f"t{min(s for s in srcs if s % 7 == 6)}"
    res = M.merge_values(d, e, m, "LAST", RUN_TS)
    assert {r.dataelementid: r.value for r in res.staged.collect()}[1] == "499"


def test_unvalidated_map_without_strategy_reports_lost(spark):
    d = spark.createDataFrame([dv(1, 10, "1", T1), dv(1, 11, "2", T2)], DATAVALUE)
    e = spark.createDataFrame(ELEMENTS, DATAELEMENT)
    m = spark.createDataFrame([(11, 10, "sum")], "source_id int, dest_id int, strategy string")
    res = M.merge_values(d, e, m, None, RUN_TS)
    assert res.staged.count() == 0
    assert rows(res.lost, "reason") == [("no strategy",), ("no strategy",)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_text_and_zero_do_not_depend_on_the_ansi_setting(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        res, _ = run(spark, [dv(1, 10, "n/a", T1), dv(1, 10, "5", T1, coc=2), dv(1, 11, "-5", T2, coc=2)], "SUM")
        assert rows(res.staged, "value") == [("0",), ("n/a",)]  # a text of its own moves as it is
        with pytest.raises(Exception, match="not a number"):
            run(spark, [dv(1, 10, "x", T1), dv(1, 11, "3", T2)], "SUM")[0].staged.collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
