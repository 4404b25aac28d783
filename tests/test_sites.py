"""Site directive rules on micro-tables (SIT1-4, SNK3, JON10)."""

from __future__ import annotations

from conftest import rows
from unitmesh.operators import sites as S

SNAP_SCHEMA = ("id string, name string, shortName string, code string, parent_id string, openingDate string, "
               "featureType string, coordinates string, created string, row_no long")
DIR_SCHEMA = ("row_no long, op string, uid string, name string, parent_uid string, new_name string, lat string, "
              "lon string, shortname string, code string")


def _snap(spark):
    return spark.createDataFrame([
        ("P", "Parent", "Parent", "PC", None, "1970-01-01", None, None, "2015-01-01", 1),
        ("S1", "O'Brien", "O'Brien", "C1", "P", "1970-01-01", "POINT", "[1, 2]", None, 2),
        ("S2", "Other", "Other", None, "P", "1970-01-01", None, None, None, 3),
    ], SNAP_SCHEMA)


def _d(spark, *rs):
    return spark.createDataFrame(list(rs), DIR_SCHEMA)


LONG = "N" * 60


def test_add_rules(spark):
    d = _d(spark,
           (1, "ADD", "N1", "O'Brien", "P", "", "", "", "", ""),        # apostrophe doubled: never matches stored name
           (2, "add", "N2", "Other", "P", "", "", "", "", ""),          # exists under P
           (3, "add", "N3", LONG, "P", "", "5", "6", "", ""),           # short name cut to 50, coordinates
           (4, "add", "N4", "New", "P", "", "", "", LONG, "K"),         # given short name is not cut
           (5, "add", "", "X", "P", "", "", "", "", ""),                # no uid
           (6, "add", "N6", "", "P", "", "", "", "", ""),               # no name
           (7, "add", "N7", "X", "", "", "", "", "", ""),               # no parent
           (8, "add", "N8", "X", "ZZ", "", "", "", "", ""))             # unknown parent
    payload, rejects = S.site_adds(d, _snap(spark))
    p = {r.id: r for r in payload.collect()}
    assert set(p) == {"N1", "N3", "N4"}
    assert p["N3"].shortName == "N" * 50 and p["N3"].coordinates == "[6,5]" and p["N3"].featureType == "POINT"
    assert p["N4"].shortName == LONG and p["N4"].code == "K" and p["N4"].coordinates is None
    assert dict(rows(rejects, "row_no", "reason")) == {
        2: S.R_EXISTS, 5: S.R_UID, 6: S.R_NAME, 7: S.R_PARENT_MISSING, 8: S.R_PARENT_UID}


def test_edit_rules_and_combined_state(spark):
    d = _d(spark,
           (1, "edit", "S1", "", "", LONG, "", "", "", ""),             # name, short name cut to 50
           (2, "edit", "S1", "", "", "", "7", "8", "", "C1"),           # own code re-submitted: rejected
           (3, "rename", "S2", "", "", "", "3", "4", "", "NEWC"),       # coordinates with a space
           (4, "update", "S2", "", "", "", "", "", "", "NEWC"),         # code claimed by an earlier row
           (5, "relocate", "S1", "", "S2", "", "", "", "", ""),         # relocation of an edited site
           (6, "relocate", "S2", "", "", "", "", "", "", ""),           # blank parent: rejected
           (7, "edit", "NOPE", "", "", "x", "", "", "", ""),            # unknown site
           (8, "frobnicate", "S1", "", "", "", "", "", "", ""))
    upd = S.site_updates(d, _snap(spark), "2024-06-30")
    st = {r.id: r for r in upd.state.collect()}
    assert st["S1"].name == LONG and st["S1"].shortName == "N" * 50 and st["S1"].parent_id == "S2"
    assert st["S1"].code == "C1" and st["S1"].coordinates == "[1, 2]"
    assert st["S1"].created == ""          # relocation sets created ('' when absent)
    assert st["S2"].coordinates == "[4, 3]" and st["S2"].code == "NEWC" and st["S2"].featureType == "POINT"
    assert rows(upd.edits, "id") == [("S1",), ("S2",)]
    assert rows(upd.relocates, "id") == [("S1",)]
    assert dict(rows(upd.rejects, "row_no", "reason")) == {
        2: S.R_CODE, 4: S.R_CODE, 6: S.R_PARENT_UID, 7: S.R_SITE}
    allr = dict(rows(S.all_rejects(d, S.site_adds(d, _snap(spark))[1], upd), "row_no", "reason"))
    assert allr[8] == S.R_UNKNOWN_OP


def test_apply_updates_and_diff(spark):
    snap = _snap(spark)
    d = _d(spark, (1, "edit", "S2", "", "", "Renamed", "", "", "", ""),
           (2, "add", "N1", "Fresh", "P", "", "", "", "", ""))
    adds, _ = S.site_adds(d, snap)
    out = S.apply_updates(snap, S.site_updates(d, snap, "2024-06-30").state, adds.drop("row_no"))
    names = dict(rows(out, "id", "name"))
    assert names == {"P": "Parent", "S1": "O'Brien", "S2": "Renamed", "N1": "Fresh"}
    diff = dict(rows(S.site_diff(d, snap), "uid", "status"))
    assert diff == {"P": "missing", "S1": "missing", "S2": "changed", "N1": "added"}


def test_country_scope(spark):
    snap = _snap(spark).unionByName(spark.createDataFrame(
        [("Q", "Other country", "Q", None, None, "1970-01-01", None, None, None, 9)], SNAP_SCHEMA))
    assert rows(S.country_sites(snap, "P"), "id") == [("S1",), ("S2",)]
    assert S.country_sites(snap, "Q").count() == 0


def test_other_fields_survive_and_repeated_uids_are_rejected(spark):
    from pyspark.sql import functions as F

    from unitmesh.sinks.writers import nest_parent
    snap = _snap(spark).withColumn("contact", F.lit("c")).withColumn("attributeValues", F.array(F.lit("v1")))
    d = _d(spark, (1, "edit", "S1", "", "", "New", "", "", "", ""), (2, "relocate", "S2", "", "S1", "", "", "", "", ""),
           (3, "add", "N1", "One", "P", "", "", "", "", ""), (4, "add", "N1", "Two", "P", "", "", "", "", ""))
    upd = S.site_updates(d, snap, "2024-06-30")
    assert rows(nest_parent(upd.edits), "id", "contact", "attributeValues") == [("S1", "c", ["v1"])]
    assert rows(nest_parent(upd.relocates), "id", "contact", "attributeValues") == [("S2", "c", ["v1"])]
    adds, rejects = S.site_adds(d, snap)
    assert rows(adds, "row_no") == [(3,)] and rows(rejects, "row_no", "reason") == [(4, S.R_REPEATED)]
    after = S.apply_updates(snap, upd.state, adds.drop("row_no"))
    assert after.groupBy("id").count().where("count > 1").count() == 0 and after.count() == 4
