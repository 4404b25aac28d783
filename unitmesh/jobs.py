"""Batch jobs for spark-submit: the entry points users of the reference run.

    spark-submit --py-files unitmesh.zip unitmesh/jobs.py merge  --datavalue P --dataelement P --orgunit P --requests P [--table name=P ...] --out DIR
    spark-submit --py-files unitmesh.zip unitmesh/jobs.py delete --orgunit P --requests P --table datavalue=P [--table ...] --out DIR
    spark-submit --py-files unitmesh.zip unitmesh/jobs.py sites  --directives CSV --snapshot P --out DIR
    spark-submit --py-files unitmesh.zip unitmesh/jobs.py paths  --orgunit P --out DIR
    spark-submit --py-files unitmesh.zip unitmesh/jobs.py registry  --units JSON --out DIR
    spark-submit --py-files unitmesh.zip unitmesh/jobs.py terms     --elements P [--stored P] --out DIR
    spark-submit --py-files unitmesh.zip unitmesh/jobs.py warehouse --values P --store DIR

(``unitmesh.zip`` = a zip of the ``unitmesh`` folder; locally ``python -m unitmesh.jobs ...``). Inputs are parquet folders, or CSV/JSON by file
extension. Every output is written to a new folder under ``--out``; inputs are never
overwritten, so switching to the new version is the caller's atomic step.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from unitmesh.operators import cascade as C
from unitmesh.operators import hierarchy as H
from unitmesh.operators import mapping as MP
from unitmesh.operators import registry as R
from unitmesh.operators import sites as S
from unitmesh.session import SCRATCH, build_session, drop_scratch
from unitmesh.sinks.writers import store, write_batches
from unitmesh.sources.files import read_csv, read_directives


def read_any(spark: SparkSession, path: str) -> DataFrame:
    low = path.lower()
    if low.endswith(".csv"):
        return read_csv(spark, path)  # text columns: a uid of digits stays as it is
    if low.endswith(".json") or low.endswith(".ndjson"):
        return spark.read.json(path)
    return spark.read.parquet(path)


def _write(df: DataFrame, out: str, name: str) -> str:
    path = os.path.join(out, name)
    df.write.mode("errorifexists").parquet(path)
    return path


def _tables(spark: SparkSession, specs: list[str]) -> dict[str, DataFrame]:
    return {name: read_any(spark, path) for name, _, path in (x.partition("=") for x in specs)}


def run_merge(spark: SparkSession, a) -> dict[str, str]:
    """Validate uid merge requests (source_uid, dest_uid, strategy), merge every valid
    pair with its strategy and remove the merged sources with their other dependents;
    write the new tables, rejected requests and lost rows."""
    ou = read_any(spark, a.orgunit)
    tables = _tables(spark, a.table) | {"datavalue": read_any(spark, a.datavalue), "organisationunit": ou}
    res = C.merge_sites(tables, read_any(spark, a.dataelement), read_any(spark, a.requests), a.run_ts, ou)
    out = {name: _write(res.table(name), a.out, name) for name in tables}
    return out | {
        "rejected_requests": _write(res.requests.where("error is not null"), a.out, "rejected_requests"),
        "lost": _write(res.merge.lost, a.out, "lost"),
        "ties": _write(res.merge.ties, a.out, "ties"),
    }


def run_delete(spark: SparkSession, a) -> dict[str, str]:
    """Cascade delete of the requested uids over the given tables (name=path)."""
    tables = _tables(spark, a.table)
    ou = read_any(spark, a.orgunit)
    tables.setdefault("organisationunit", ou)
    res = C.delete_sites(tables, read_any(spark, a.requests), ou, chart_literal=not a.resequence_chart)
    out = {name: _write(res.table(name), a.out, name) for name in tables}
    out["requests"] = _write(res.requests, a.out, "requests")
    out["counts"] = _write(res.counts(), a.out, "counts")
    return out


def run_sites(spark: SparkSession, a) -> dict[str, str]:
    """Directive CSV against a site snapshot: the add / edit / relocate batches (NDJSON,
    each only when non-empty), the rejects, the whole snapshot after the import and the
    paths of its sites. ``--country`` limits the sites the directives are checked
    against, not the snapshot."""
    d = read_directives(spark, a.directives, header=not a.no_header)
    whole = read_any(spark, a.snapshot)
    snap = S.country_sites(whole, a.country) if a.country else whole
    adds, add_rejects = S.site_adds(d, snap)
    upd = S.site_updates(d, snap, a.today)
    written = write_batches(adds, upd.edits, upd.relocates, os.path.join(a.out, "batches"))
    out = {f"batch_{k}": os.path.join(a.out, "batches", k) for k, ok in written.items() if ok}
    out["rejects"] = _write(S.all_rejects(d, add_rejects, upd), a.out, "rejects")
    out["snapshot"] = _write(S.apply_updates(whole, upd.state, adds.drop("row_no")), a.out, "snapshot")
    after = spark.read.parquet(out["snapshot"])
    out["paths"] = _write(H.materialize_paths(after.select(
        F.col("id").alias("organisationunitid"), F.col("id").alias("uid"), F.col("parent_id").alias("parentid"))), a.out, "paths")
    return out


def run_paths(spark: SparkSession, a) -> dict[str, str]:
    """Paths and levels of every unit (organisationunitid, uid, parentid)."""
    ou = read_any(spark, a.orgunit).select("organisationunitid", "uid", "parentid")
    return {"paths": _write(H.materialize_paths(ou), a.out, "paths")}


def run_registry(spark: SparkSession, a) -> dict[str, str]:
    """Facility records of an export of units (JSON with ancestors and
    organisationUnitGroups), ordered by id, as JSON records."""
    records = R.to_facility(read_any(spark, a.units), sort=True)
    path = os.path.join(a.out, "facility")
    records.write.mode("errorifexists").json(path)
    return {"facility": path, "admin_report": _write(R.admin_report(read_any(spark, a.units)), a.out, "admin_report")}


def run_terms(spark: SparkSession, a) -> dict[str, str]:
    """Stored terminology mappings extended with the data elements not stored yet."""
    incoming = R.to_mappings(read_any(spark, a.elements))
    merged = R.upsert_terms(read_any(spark, a.stored), incoming) if a.stored else incoming
    return {"terms": _write(merged, a.out, "terms")}


def run_warehouse(spark: SparkSession, a) -> dict[str, str]:
    """dataValues records in warehouse names, stored by period; a period that is stored
    again is replaced, the others stay."""
    store(MP.to_warehouse(read_any(spark, a.values)), a.store, partition_by=["period"], cluster_by=["location"])
    return {"store": a.store}


def parser() -> argparse.ArgumentParser:
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    p = argparse.ArgumentParser(prog="unitmesh.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    m = sub.add_parser("merge")
    for f in ("datavalue", "dataelement", "orgunit", "requests", "out"):
        m.add_argument(f"--{f}", required=True)
    m.add_argument("--table", action="append", default=[], help="name=path of a dependent table, repeatable")
    m.add_argument("--run-ts", dest="run_ts", default=now.strftime("%Y-%m-%d %H:%M:%S"))
    d = sub.add_parser("delete")
    for f in ("orgunit", "requests", "out"):
        d.add_argument(f"--{f}", required=True)
    d.add_argument("--table", action="append", default=[], help="name=path, repeatable")
    d.add_argument("--resequence-chart", action="store_true", help="renumber the chart list like the others")
    s = sub.add_parser("sites")
    for f in ("directives", "snapshot", "out"):
        s.add_argument(f"--{f}", required=True)
    s.add_argument("--no-header", action="store_true")
    s.add_argument("--country", default=None, help="check against the sites below this uid only")
    s.add_argument("--today", default=now.strftime("%Y-%m-%d"))
    t = sub.add_parser("paths")
    for f in ("orgunit", "out"):
        t.add_argument(f"--{f}", required=True)
    r = sub.add_parser("registry")
    for f in ("units", "out"):
        r.add_argument(f"--{f}", required=True)
    e = sub.add_parser("terms")
    for f in ("elements", "out"):
        e.add_argument(f"--{f}", required=True)
    e.add_argument("--stored", default=None)
    w = sub.add_parser("warehouse")
    for f in ("values", "store"):
        w.add_argument(f"--{f}", required=True)
    return p


JOBS = {"merge": run_merge, "delete": run_delete, "sites": run_sites, "paths": run_paths,
        "registry": run_registry, "terms": run_terms, "warehouse": run_warehouse}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict[str, str]:
    a = parser().parse_args(argv)
    spark = spark or build_session(app_name=f"unitmesh-{a.job}")
    before = len(SCRATCH)
    out = JOBS[a.job](spark, a)
    drop_scratch(spark, before)  # every output is written
    return out


if __name__ == "__main__":
    for k, v in main().items():
        print(f"{k}\t{v}")
