"""Merges replayed in request order, against a plain merge called once per request."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest

from conftest import rows
from unitmesh.operators import merge as M
from unitmesh.operators.replay import merge_levels, replay_merges
from unitmesh.schemas import DATAELEMENT, DATAVALUE, DATAVALUE_COLUMNS, ORGUNIT

RUN_TS = "2024-06-30 12:00:00"
NOW = dt.datetime(2024, 6, 30, 12)
ELEMENTS = [(1, "INTEGER"), (2, "TEXT"), (3, None), (5, "NUMBER")]
REQUEST = "request_no int, source_id int, dest_id int, strategy string"


def pairwise(values, source, dest, strategy):
    """One merge call: rows as dicts in, rows as dicts out."""
    kind = dict(ELEMENTS)
    keep = [v for v in values if v["sourceid"] not in (source, dest)]
    groups = defaultdict(list)
    for v in values:
        key = (v["dataelementid"], v["periodid"], v["categoryoptioncomboid"], v["attributeoptioncomboid"])
        if v["sourceid"] in (source, dest) and v["deleted"] is False and None not in key:
            groups[key].append(v)
    latest = lambda v: (v["lastupdated"] is None, v["lastupdated"] or dt.datetime.min)
    for (de, *_), found in groups.items():
        valuetype = kind.get(de)
        if len(found) == 1:
            keep.append({**found[0], "sourceid": dest, "lastupdated": NOW})
        elif valuetype is None:
            continue
        elif valuetype == "TEXT":
            top = max(map(latest, found))
            won = [v for v in found if latest(v) == top]
            least = min(v["sourceid"] for v in won)
            keep += [{**v, "sourceid": dest, "lastupdated": NOW} for v in won if v["sourceid"] == least]
        elif strategy in ("FIRST", "LAST"):
            top = (max if strategy == "LAST" else min)(map(latest, found))
            for v in found:
                moved = {**v, "sourceid": dest}
                if latest(v) == top and moved not in keep:
                    keep.append(moved)
        else:
            with localcontext() as c:
                c.prec = 60
                nums = [Decimal(v["value"]) for v in found]
                n = {"SUM": sum, "MAX": max, "MIN": min, "AVG": lambda x: sum(x) / len(x)}[strategy](nums)
                n = n.quantize(Decimal(1).scaleb(-10), ROUND_HALF_UP)
            text = f"{n:f}".rstrip("0").rstrip(".")
            keep.append({**found[0], "sourceid": dest, "value": "0" if text in ("-0", "") else text, "storedby": "admin",
                         "lastupdated": NOW, "comment": None, "followup": False, "created": NOW, "deleted": False})
    return keep


def values_of(rnd, sites, n):
    day = lambda: None if rnd.random() < 0.1 else dt.datetime(2020, 1, rnd.randint(1, 9))
    return [(rnd.choice((1, 2, 3, 4, 5)), 2020, rnd.choice(sites), rnd.choice((1, 2, 3, None)), str(rnd.randint(-9, 99)), "u", day(),
             rnd.choice((None, "c")), False, rnd.randint(1, 2), dt.datetime(2019, 1, 1), rnd.choice((False, False, False, False, True, None))) for _ in range(n)]


def as_text(found):
    return sorted(tuple(str(r[c]) for c in DATAVALUE_COLUMNS) for r in found)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_one_call_per_request(spark, seed):
    rnd = random.Random(seed)
    sites = list(range(10, 22))
    values = values_of(rnd, [*sites, 99], 500)
    requests = [(10 * i, *rnd.sample(sites, 2), rnd.choice(M.STRATEGIES)) for i in range(9)]
    want = [dict(zip(DATAVALUE_COLUMNS, v)) for v in values]
    for _, source, dest, strategy in requests:
        want = pairwise(want, source, dest, strategy)
    rnd.shuffle(requests)  # the number decides, not the place
    base = spark.createDataFrame(values, DATAVALUE)
    res = replay_merges(base, spark.createDataFrame(ELEMENTS, DATAELEMENT), spark.createDataFrame(requests, REQUEST), RUN_TS)
    got = M.replace_sites(base, res.staged, res.sites, res.sites_small)
    assert as_text(r.asDict() for r in got.collect()) == as_text(want)
    touched = {s for r in requests for s in r[1:3]}
    assert {r[0] for r in res.sites.collect()} == touched


def test_average_of_several_sources_is_that_of_repeated_calls(spark):
    base = spark.createDataFrame([(1, 2020, s, 1, v, "u", None, None, False, 1, None, False) for s, v in ((10, "1"), (11, "2"), (12, "6"))], DATAVALUE)
    requests = spark.createDataFrame([(1, 11, 10, "AVG"), (2, 12, 10, "AVG")], REQUEST)
    elements = spark.createDataFrame(ELEMENTS, DATAELEMENT)
    assert rows(replay_merges(base, elements, requests, RUN_TS).staged, "sourceid", "value") == [(10, "3.75")]
    together = M.merge_values(base, elements, requests.drop("request_no"), None, RUN_TS)
    assert rows(together.staged, "value") == [("3",)]


def test_levels(spark):
    req = spark.createDataFrame([(1, 2, 1, "SUM"), (2, 4, 3, "SUM"), (3, 3, 1, "SUM"), (4, 6, 5, "MAX"), (5, 1, 5, "SUM"),
                                 (5, 1, 5, "SUM"), (None, 8, 7, "SUM"), (6, 8, 7, "MIN")], REQUEST)
    levels, last = merge_levels(req)
    assert last == 3
    assert rows(levels, "request_no", "level") == [(1, 1), (2, 1), (3, 2), (4, 1), (5, 3), (6, 2), (None, 1)]


def test_lost_rows_name_their_level_and_no_requests_give_nothing(spark):
    base = spark.createDataFrame([(3, 2020, s, 1, "1", "u", None, None, False, 1, None, False) for s in (10, 11, 12)], DATAVALUE)
    elements = spark.createDataFrame(ELEMENTS, DATAELEMENT)
    res = replay_merges(base, elements, spark.createDataFrame([(1, 11, 10, "SUM"), (2, 12, 10, "SUM")], REQUEST), RUN_TS)
    assert rows(res.lost, "sourceid", "level") == [(10, 1), (11, 1)]
    assert rows(res.staged, "sourceid") == [(10,)]  # the third row met nothing any more
    none = replay_merges(base, elements, spark.createDataFrame([], REQUEST), RUN_TS)
    assert none.staged.count() == none.lost.count() == none.sites.count() == 0
    for bad in ((1, 10, 10, "SUM"), (1, None, 10, "SUM")):
        with pytest.raises(ValueError, match="two different sites"):
            replay_merges(base, elements, spark.createDataFrame([bad], REQUEST), RUN_TS)


def test_validation_in_order_allows_chains(spark):
    ou = spark.createDataFrame([(i, u, None) for i, u in enumerate("ABC", 1)], ORGUNIT)
    req = spark.createDataFrame([("A", "B", "SUM"), ("B", "C", "MAX"), ("A", "C", "AVG"), ("C", "C", "SUM")], "source_uid string, dest_uid string, strategy string")
    found = M.validate_merges(req, ou, in_order=True).select("source_uid", "dest_uid", "error").collect()
    assert {(r[0], r[1]): r[2] for r in found} == {("A", "B"): None, ("B", "C"): None, ("A", "C"): None, ("C", "C"): M.ERR_SELF}
