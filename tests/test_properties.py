"""Property checks against plain pandas on random inputs."""

from __future__ import annotations

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from unitmesh.operators import cascade as C
from unitmesh.operators.numbering import row_numbers

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

rows_strategy = st.lists(st.tuples(st.sampled_from([1, 1, 1, 1, 2, 3]), st.integers(0, 50)),
                         min_size=1, max_size=120)


@SETTINGS
@given(rows_strategy, st.integers(1, 6))
def test_row_numbers_equal_pandas_rank(spark, data, parts):
    pdf = pd.DataFrame(data, columns=["g", "o"]).drop_duplicates().reset_index(drop=True)
    pdf["u"] = range(len(pdf))
    df = spark.createDataFrame(pdf)
    got = row_numbers(df, ["g"], ["o", "u"], out="rn", partitions=parts).toPandas()
    want = pdf.assign(rn=pdf.sort_values(["o", "u"]).groupby("g").cumcount() + 1)
    merged = got.merge(want, on=["g", "o", "u"], suffixes=("", "_w"))
    assert len(merged) == len(pdf)
    assert (merged["rn"] == merged["rn_w"]).all()


@SETTINGS
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 12), st.integers(0, 30)), min_size=1, max_size=60),
       st.sets(st.integers(1, 12), max_size=4))
def test_resequence_gives_dense_orders_in_touched_objects(spark, members, deleted):
    pdf = (pd.DataFrame(members, columns=["objectid", "organisationunitid", "sort_order"])
           .drop_duplicates(["objectid", "organisationunitid"]))
    df = spark.createDataFrame(pdf)
    ids = spark.createDataFrame([(i,) for i in sorted(deleted)] or [(-1,)], "organisationunitid long")
    out = C.resequence(df, "objectid", ids).toPandas()
    touched = set(pdf[pdf.organisationunitid.isin(deleted)].objectid)
    assert not out.organisationunitid.isin(deleted).any()
    assert len(out) == (~pdf.organisationunitid.isin(deleted)).sum()
    for obj, grp in out.groupby("objectid"):
        if obj in touched:
            assert sorted(grp.sort_order) == list(range(len(grp)))
        else:
            before = pdf[pdf.objectid == obj].set_index("organisationunitid").sort_order
            assert (grp.set_index("organisationunitid").sort_order == before.loc[grp.organisationunitid]).all()


# --- MRG1 against a row-by-row pandas reading of the rules -------------------------------
import datetime as _dt  # noqa: E402

from unitmesh.operators import merge as M  # noqa: E402
from unitmesh.schemas import DATAELEMENT, DATAVALUE, DATAVALUE_COLUMNS, VALUE_KEY  # noqa: E402

_RUN = "2024-06-30 12:00:00"
_NOW = pd.Timestamp(_RUN)
_TYPES = {1: "INTEGER", 2: "TEXT", 3: None}  # 4 is unknown
_NUMERIC = {1}
_OTHER = {2}


def _expected(values: pd.DataFrame, strategy: str) -> list[tuple]:
    live = values[(values.sourceid.isin([10, 11])) & (values.deleted == False)].copy()  # noqa: E712
    live = live.dropna(subset=VALUE_KEY)
    out = []
    for _, g in live.groupby(VALUE_KEY, dropna=True):
        n = len(g)
        de = int(g.dataelementid.iloc[0])
        if n == 1:
            r = g.iloc[0].copy(); r.sourceid = 10; r.lastupdated = _NOW; out.append(r)
        elif de in _NUMERIC and strategy in ("SUM", "MAX", "MIN", "AVG"):
            v = g.value.astype(float)
            agg = {"SUM": v.sum(), "MAX": v.max(), "MIN": v.min(), "AVG": round(v.mean(), 10)}[strategy]
            r = g.iloc[0].copy()
            r.sourceid, r.value, r.storedby, r.lastupdated, r.comment = 10, agg, "admin", _NOW, None
            r.followup, r.created, r.deleted = False, _NOW, False
            out.append(r)
        elif de in _NUMERIC:
            ts = g.lastupdated
            if strategy == "FIRST":
                best = g[ts == ts.min()] if ts.notna().any() else g
            else:
                best = g[ts.isna()] if ts.isna().any() else g[ts == ts.max()]
            best = best.assign(sourceid=10).drop_duplicates()
            out.extend(r for _, r in best.iterrows())
        elif de in _OTHER:
            ts = g.lastupdated
            cand = g[ts.isna()] if ts.isna().any() else g[ts == ts.max()]
            cand = cand[cand.sourceid == cand.sourceid.min()]
            for _, r in cand.iterrows():
                r = r.copy(); r.sourceid = 10; r.lastupdated = _NOW; out.append(r)
    def norm(r):
        v = r.value
        v = float(v) if int(r.dataelementid) in _NUMERIC else v
        lu = None if pd.isna(r.lastupdated) else pd.Timestamp(r.lastupdated)
        return (int(r.dataelementid), int(r.categoryoptioncomboid), int(r.sourceid), v, lu)
    return sorted((norm(r) for r in out), key=str)


_ts = st.one_of(st.none(), st.sampled_from([_dt.datetime(2020, 1, 1), _dt.datetime(2021, 1, 1)]))
_row = st.tuples(st.sampled_from([1, 1, 2, 3, 4]), st.sampled_from([10, 11, 12]), st.integers(1, 9),
                 _ts, st.one_of(st.none(), st.integers(1, 2)), st.sampled_from([False, False, True, None]))


@SETTINGS
@given(st.lists(_row, min_size=1, max_size=25), st.sampled_from(["SUM", "AVG", "MAX", "MIN", "FIRST", "LAST"]))
def test_merge_matches_rule_reading(spark, raw, strategy):
    recs = [(de, 2020, site, coc, str(v), "u", ts, None, False, 1, ts, dl) for de, site, v, ts, coc, dl in raw]
    d = spark.createDataFrame(recs, DATAVALUE)
    e = spark.createDataFrame([(k, v) for k, v in _TYPES.items()], DATAELEMENT)
    m = spark.createDataFrame([(11, 10)], "source_id int, dest_id int")
    got_df = M.merge_values(d, e, m, strategy, _RUN).staged.toPandas()
    got = sorted(((int(r.dataelementid), int(r.categoryoptioncomboid), int(r.sourceid),
                   float(r.value) if int(r.dataelementid) in _NUMERIC else r.value,
                   None if pd.isna(r.lastupdated) else pd.Timestamp(r.lastupdated))
                  for _, r in got_df.iterrows()), key=str)
    pdf = pd.DataFrame(recs, columns=DATAVALUE_COLUMNS)
    pdf["lastupdated"] = pd.to_datetime(pdf["lastupdated"])
    assert got == _expected(pdf, strategy)
