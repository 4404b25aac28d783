"""Exact sums, averages, highest and lowest of numbers in text against Python's decimals."""

from __future__ import annotations

import decimal
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from unitmesh.operators import merge as M
from unitmesh.schemas import DATAELEMENT, DATAVALUE
from unitmesh.functions.decimals import carried, divided, limbs_text, sum_limbs, to_limbs

CTX = decimal.Context(prec=400)


def text(d: Decimal) -> str:
    s = f"{d:f}"
    s = s.rstrip("0").rstrip(".") if "." in s else s
    return "0" if s in ("-0", "") else s


def numbers(rng, n):
    out = []
    for _ in range(n):
        whole = "".join(rng.choice("0123456789") for _ in range(rng.choice([1, 3, 18, 19, 36, 60])))
        part = "".join(rng.choice("0123456789") for _ in range(rng.choice([0, 1, 10, 20, 36])))
        out.append(rng.choice(["", "-", "+"]) + whole + ("." + part if part else ""))
    return out


def test_sums_averages_and_bounds(spark):
    rng = random.Random(2)
    groups = {g: numbers(rng, rng.randrange(1, 8)) for g in range(60)}
    groups |= {100: ["9" * 72, "1"], 101: ["0.1", "-0.1"], 102: ["-0.00000000005", "0"], 103: ["1", "1", "0"], 104: ["999999999999999999.99999999995", "0.00"]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g int, v string").withColumn("l", to_limbs(F.col("v"))["limbs"])
    got = (df.groupBy("g").agg(F.array(*sum_limbs(F.col("l"))).alias("s"), F.count("l").alias("n"), F.max("l").alias("hi"), F.min("l").alias("lo"))
           .select("g", limbs_text(carried(F.col("s"))), limbs_text(divided(carried(F.col("s")), F.col("n"))),
                   *[limbs_text(carried(F.transform(c, lambda x: x.cast("decimal(38,0)")))) for c in ("hi", "lo")]).collect())
    for g, s, a, hi, lo in got:
        vs = [Decimal(v) for v in groups[g]]
        total = Decimal(0)
        for v in vs:
            total = CTX.add(total, v)
        mean = CTX.divide(total, Decimal(len(vs))).quantize(Decimal("1e-10"), decimal.ROUND_HALF_UP, CTX)
        assert (s, a, hi, lo) == (text(total), text(mean), text(max(vs)), text(min(vs))), groups[g]


@pytest.mark.parametrize("value,want", [
    (" 12 ", "12"), ("+.5", "0.5"), ("5.", "5"), ("1e3", "1000"), ("1.25E-3", "0.00125"), ("-0", "0"), ("007.10", "7.1"), ("1e-36", "0." + "0" * 35 + "1"),
    ("", "text"), (".", "text"), ("e5", "text"), ("1e", "text"), ("1.2.3", "text"), ("n/a", "text"), ("NaN", "text"), ("--1", "text"),
    ("9" * 73, "long"), ("1e80", "long"), ("0." + "0" * 36 + "1", "long"), ("0e900", "0"), (None, None)])
def test_texts(spark, value, want):
    r = (spark.createDataFrame([(value,)], "v string").select(to_limbs(F.col("v")).alias("x"))
         .select("x.state", limbs_text(carried(F.transform("x.limbs", lambda x: x.cast("decimal(38,0)")))).alias("t")).first())
    assert (r["t"] if r["state"] == "ok" else r["state"]) == want


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("strategy,want", [("SUM", "1.123456789012"), ("MAX", "1"), ("MIN", "0.123456789012"), ("AVG", "0.5617283945")])
def test_merge_keeps_every_digit(spark, ansi, strategy, want):
    def merged(*values, mode="try"):
        d = spark.createDataFrame([(1, 2020, site, 1, v, "u", None, None, False, 1, None, False) for site, v in zip((10, 11), values)], DATAVALUE)
        e = spark.createDataFrame([(1, "NUMBER")], DATAELEMENT)
        m = spark.createDataFrame([(11, 10)], "source_id int, dest_id int")
        return rows(M.merge_values(d, e, m, strategy, "2024-06-30 12:00:00", mode).staged, "value")

    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert merged("0.123456789012", "1", mode="ansi") == [(want,)]
        big = "9" * 60 + "." + "1" * 20
        assert merged(big, "1") == [({"SUM": "1" + "0" * 60 + "." + "1" * 20, "MAX": big, "MIN": "1", "AVG": "5" + "0" * 59 + ".0555555556"}[strategy],)]
        with pytest.raises(Exception, match="more digits"):
            merged("1" * 73, "1")
        assert merged("n/a", None) == [(None,)]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
