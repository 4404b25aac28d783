"""Training corpus pipeline: documents to packed sequences.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir), works on all
documents that its predecessor kept and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``. All but the last return the columns of
``documents``. A stage judges its own input: counts, models and groups are made anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from unitmesh.llm.common import written
from unitmesh.llm.decontam import drop_contaminated
from unitmesh.llm.line_dedup import dedup_lines
from unitmesh.llm.packing import pack
from unitmesh.llm.quality import keep_quality
from unitmesh.llm.simhash import keep_one_of_each
from unitmesh.session import table_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier rejects go."""
    return keep_quality(docs, spark.read.parquet(table_path(sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat across documents go, except in the largest doc_id; n_chars follows."""
    done = dedup_lines(docs, report=False)
    return done.withColumn("n_chars", F.char_length("text").cast("long")).select(*done.columns) if "n_chars" in done.columns else done


def simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with an occurring benchmark window go."""
    return drop_contaminated(docs, spark.read.parquet(table_path(sf_dir, "benchmark")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The bins of what is left: one row for each piece of each document."""
    return pack(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("simhash", simhash),
          ("decontamination", decontamination), ("packing", packing)]

# A fitted classifier, components and best fit are not SQL; tests/llm compare every stage
# with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training corpus of the whole documents table, packed."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
