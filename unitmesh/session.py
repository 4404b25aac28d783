"""Session construction and cluster-shared scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins and coalesces partitions at run
# time, splits skewed sort-merge join partitions, and timestamps stay in UTC so the
# results equal the SQL oracle's.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The pandas UDFs see whole documents; smaller Arrow batches bound worker memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # A JSON object that repeats a key keeps the last value, as Python's json does.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "unitmesh", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the engine's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; the shuffle
    partition count should then be sized to the data (about 128-256 MB per task).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the SparkContext.

    The cluster names it in ``spark.checkpoint.dir``; a private temporary folder is
    created only where that is unset and the master is local (tests).
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        path = tempfile.mkdtemp(prefix="unitmesh-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession | None = None) -> None:
    """Make ``unitmesh`` importable in the Python workers (needed by the pandas UDFs):
    zip the package once per application and register it with ``addPyFile``, which
    distributes it to every executor. Harmless where the package is installed."""
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import shutil

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    ckpt = checkpoint_dir(spark)
    local = ckpt.startswith("/") or ckpt.startswith("file:")
    base = (ckpt.replace("file:", "", 1) if local else tempfile.mkdtemp(prefix="unitmesh-code-"))
    target = os.path.join(base, f"unitmesh-code-{uuid.uuid4().hex[:8]}")
    os.makedirs(base, exist_ok=True)
    archive = shutil.make_archive(target, "zip", root_dir=os.path.dirname(pkg_dir), base_dir="unitmesh")
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> None:
    """Per-session setup every job relies on: checkpoint folder, shipped code and the JSON
    reading that results depend on."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    checkpoint_dir(spark)
    ship_package(spark)


# Scratch folders named by this process, in order.
SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    SCRATCH.append(f"{base}/unitmesh-{name}-{uuid.uuid4().hex[:12]}")
    return SCRATCH[-1]


def drop_scratch(spark: SparkSession, first: int = 0) -> None:
    """Delete the scratch folders named since ``SCRATCH`` had ``first`` entries, through
    Spark's file systems. Only for the end of a job whose outputs are all written."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in SCRATCH[first:]:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(conf).delete(folder, True)
    del SCRATCH[first:]


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
