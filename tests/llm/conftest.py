from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) pairs, with optional extra columns."""
    def make(pairs, **extra):
        rows = [(i, t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(pairs)]
        df = spark.createDataFrame(rows, DOCS).repartition(3)
        from pyspark.sql import functions as F
        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df
    return make


@pytest.fixture(scope="session")
def corpus(spark):
    """The whole documents table of the smallest test data as (doc_id, text) pairs."""
    return [(r[0], r[1]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
            .select("doc_id", "text").collect()]
