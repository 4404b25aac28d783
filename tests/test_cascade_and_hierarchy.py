"""Cascade delete, re-sequencing, skew-safe numbering and paths on micro-tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from conftest import rows
from unitmesh.operators import cascade as C
from unitmesh.operators import hierarchy as H
from unitmesh.operators.numbering import row_numbers
from unitmesh.schemas import ORGUNIT


def _units(spark):
    # 1 root, 2 and 3 leaves under 1, 4 leaf under 2 (so 2 has a child)
    return spark.createDataFrame([(1, "R", None), (2, "A", 1), (3, "B", 1), (4, "C", 2)], ORGUNIT)


def test_unknown_uid_changes_nothing_and_children_refuse(spark):
    ou = _units(spark)
    dv = spark.createDataFrame([(2, "x"), (3, "y"), (4, "z")], "sourceid int, value string")
    req = spark.createDataFrame([("NOPE",), ("A",), ("B",)], "uid string")
    res = C.delete_sites({"datavalue": dv, "organisationunit": ou}, req, ou)
    st = dict(rows(res.requests, "uid", "status"))
    assert st == {"NOPE": C.STATUS_UNKNOWN, "A": C.ERR_CHILDREN, "B": C.STATUS_DELETED}
    assert rows(res.table("datavalue"), "sourceid") == [(2,), (4,)]
    assert rows(res.table("organisationunit"), "organisationunitid") == [(1,), (2,), (4,)]
    assert dict(rows(res.counts(), "table_name", "deleted_rows")) == {"datavalue": 1, "organisationunit": 1}


def test_two_hop_delete(spark):
    ou = _units(spark)
    inst = spark.createDataFrame([(100, 3), (101, 4)], "programstageinstanceid long, organisationunitid int")
    tedv = spark.createDataFrame([(100, 1), (100, 2), (101, 1)], "programstageinstanceid long, dataelementid int")
    req = spark.createDataFrame([("B",)], "uid string")
    res = C.delete_sites({"programstageinstance": inst, "trackedentitydatavalue": tedv}, req, ou)
    assert rows(res.table("trackedentitydatavalue"), "programstageinstanceid") == [(101,)]
    assert rows(res.table("programstageinstance"), "programstageinstanceid") == [(101,)]


def test_resequence_touched_objects_only_and_chart_literal(spark):
    members = spark.createDataFrame(
        [(1, 2, 0), (1, 3, 1), (1, 4, 5), (2, 2, 0), (2, 4, 7)],
        "objectid int, organisationunitid int, sort_order int")
    ids = spark.createDataFrame([(3,)], "organisationunitid int")
    out = C.resequence(members, "objectid", ids)
    # object 1 lost unit 3: renumbered 0..n-1; object 2 untouched keeps its gap
    assert rows(out) == [(1, 2, 0), (1, 4, 1), (2, 2, 0), (2, 4, 7)]
    lit = C.resequence(members, "objectid", ids, touched_after_delete=True)
    assert rows(lit) == [(1, 2, 0), (1, 4, 5), (2, 2, 0), (2, 4, 7)]


def test_row_numbers_split_a_hot_group(spark):
    # one group with 90% of the rows must still be numbered 1..n in order
    n = 5000
    df = spark.range(n).select((F.when(F.col("id") % 10 == 0, F.col("id") % 7).otherwise(F.lit(99))).alias("g"),
                               (F.lit(n) - F.col("id")).alias("o"))
    out = row_numbers(df, ["g"], ["o"], out="rn", partitions=8)
    got = out.collect()
    by_group: dict[int, list[tuple[int, int]]] = {}
    for r in got:
        by_group.setdefault(r.g, []).append((r.o, r.rn))
    for g, pairs in by_group.items():
        pairs.sort()
        assert [rn for _, rn in pairs] == list(range(1, len(pairs) + 1)), g
    assert len(got) == n


def test_paths_levels_and_unresolved(spark):
    ou = spark.createDataFrame(
        [(1, "R", None), (2, "A", 1), (3, "B", 2), (4, "C", 3), (5, "X", 6), (6, "Y", 5), (7, "D", 99)], ORGUNIT)
    p = {r.uid: (r.path, r.level, r.resolved) for r in H.materialize_paths(ou).collect()}
    assert p["C"] == ("/R/A/B/C", 4, True)
    assert p["R"] == ("/R", 1, True)
    assert p["X"] == (None, None, False)   # cycle
    assert p["D"] == (None, None, False)   # dangling parent
    d = H.descendants(H.materialize_paths(ou), spark.createDataFrame([("A",)], "uid string"))
    assert rows(d) == [("A", "B"), ("A", "C")]


def test_row_numbers_keep_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), (1, 2)], "g int, o int")
    out = rows(row_numbers(df, ["g"], ["o"], out="rn", partitions=2), "g", "o", "rn")
    assert out == [(1, 2, 1), (None, 1, 1), (None, 3, 2)]


def test_paths_of_a_deep_chain_with_cycles_and_repeated_ids(spark):
    n = 200
    units = [(i, f"U{i}", i - 1 if i else None) for i in range(n)] + [(5, "V5", 0)]  # id 5 again: the smallest uid stands
    units += [(1000 + i, f"C{i}", 1000 + (i + 1) % 9) for i in range(9)] + [(2000, "L", 1003), (None, "N", 0)]
    p = {r.organisationunitid: (r.path, r.level, r.resolved) for r in H.materialize_paths(spark.createDataFrame(units, ORGUNIT)).collect()}
    assert len(p) == n + 10
    assert p[n - 1] == ("".join(f"/U{i}" for i in range(n)), n, True)
    assert all(p[i] == (None, None, False) for i in [*range(1000, 1009), 2000])


def test_finished_units_are_not_joined_again(spark, monkeypatch):
    sizes = []
    real = H._follow
    monkeypatch.setattr(H, "_follow", lambda cur, paths: sizes.append(cur.where("end is null").count()) or real(cur, paths))
    H.materialize_paths(spark.createDataFrame([(i, f"U{i}", i - 1 if i else None) for i in range(20)], ORGUNIT))
    assert sizes == [19, 18, 16, 12, 4]
