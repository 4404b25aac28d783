"""Smoke test of the spark-submit job entry points on stand-in tables."""

from __future__ import annotations

import os
import tempfile

from unitmesh import jobs
from unitmesh.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_jobs_end_to_end(spark):
    d = tempfile.mkdtemp(prefix="unitmesh-jobs-")
    paths = {}
    for n in ("f_datavalue", "f_dataelement", "f_orgunit", "f_merge_request", "f_delete_request",
              "f_snapshot", "f_stage_instance", "f_stage_value"):
        paths[n] = os.path.join(d, "in", n)
        fx.load(spark, SF, n).write.parquet(paths[n])
    from unitmesh.session import checkpoint_dir
    scratch = checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(scratch))
    out = jobs.main(["merge", "--datavalue", paths["f_datavalue"], "--dataelement", paths["f_dataelement"],
                     "--orgunit", paths["f_orgunit"], "--requests", paths["f_merge_request"],
                     "--out", os.path.join(d, "merge"), "--run-ts", "2024-06-30 12:00:00"], spark)
    assert spark.read.parquet(out["datavalue"]).count() > 0
    assert set(os.listdir(scratch)) <= before  # the job's scratch tables are gone
    assert spark.read.parquet(out["rejected_requests"]).count() > 0
    assert spark.read.parquet(out["organisationunit"]).count() < spark.read.parquet(paths["f_orgunit"]).count()
    out = jobs.main(["delete", "--orgunit", paths["f_orgunit"], "--requests", paths["f_delete_request"],
                     "--table", f"datavalue={paths['f_datavalue']}",
                     "--table", f"programstageinstance={paths['f_stage_instance']}",
                     "--table", f"trackedentitydatavalue={paths['f_stage_value']}",
                     "--out", os.path.join(d, "delete")], spark)
    counts = dict(spark.read.parquet(out["counts"]).collect())
    assert counts["datavalue"] > 0 and set(counts) >= {"programstageinstance", "trackedentitydatavalue"}
    csv = os.path.join(d, "directives.csv")
    (fx.load(spark, SF, "f_directive")
     .select("op", "uid", "name", "parent_uid", "new_name", "lat", "lon", "shortname", "code", "row_no")
     .coalesce(1).write.option("header", True).csv(csv))
    out = jobs.main(["sites", "--directives", csv, "--snapshot", paths["f_snapshot"],
                     "--out", os.path.join(d, "sites"), "--today", "2024-06-30"], spark)
    assert "batch_add" in out and spark.read.parquet(out["rejects"]).count() > 0
    scoped = jobs.main(["sites", "--directives", csv, "--snapshot", paths["f_snapshot"], "--country", "R0000000001",
                        "--out", os.path.join(d, "sites_country"), "--today", "2024-06-30"], spark)
    whole = {r["id"] for r in spark.read.parquet(paths["f_snapshot"]).collect()}
    kept = {r["id"] for r in spark.read.parquet(scoped["snapshot"]).collect()}
    assert whole <= kept  # the country limits the checks, not the snapshot
    assert spark.read.parquet(scoped["rejects"]).count() > spark.read.parquet(out["rejects"]).count()
    assert spark.read.parquet(scoped["paths"]).count() == len(kept)
    out = jobs.main(["paths", "--orgunit", paths["f_orgunit"], "--out", os.path.join(d, "paths")], spark)
    assert spark.read.parquet(out["paths"]).where("resolved").count() == spark.read.parquet(paths["f_orgunit"]).count()
    nested = os.path.join(d, "units.json")
    from unitmesh.plans.q_registry import nested_units
    nested_units(spark, SF).write.json(nested)
    out = jobs.main(["registry", "--units", nested, "--out", os.path.join(d, "registry")], spark)
    ids = [r["id"] for r in spark.read.json(out["facility"]).select("id").collect()]
    assert ids == sorted(ids) and len(ids) == spark.read.json(nested).count()  # PRJ9: ordered by id
    terms = os.path.join(d, "elements")
    fx.load(spark, SF, "f_term_incoming").write.parquet(terms)
    out = jobs.main(["terms", "--elements", terms, "--out", os.path.join(d, "terms")], spark)
    again = jobs.main(["terms", "--elements", terms, "--stored", out["terms"], "--out", os.path.join(d, "terms2")], spark)
    assert spark.read.parquet(again["terms"]).count() == spark.read.parquet(terms).count()
    values = os.path.join(d, "values")
    fx.load(spark, SF, "f_payload").write.parquet(values)
    out = jobs.main(["warehouse", "--values", values, "--store", os.path.join(d, "warehouse")], spark)
    assert spark.read.parquet(out["store"]).count() == spark.read.parquet(values).count()
