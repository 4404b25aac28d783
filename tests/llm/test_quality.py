"""Quality classifier: held-out accuracy, leakage and edges."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from unitmesh.llm import quality
from unitmesh.llm.common import written
from unitmesh.llm.quality import keep_quality, prior_from_histograms, score_quality

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy_and_no_label_leak(spark, tables):
    docs, labels = tables
    scored = score_quality(docs, labels).cache()
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.96
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None]).mean() > 0.99
    assert (good >= 0.7).mean() > 0.98
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    # Labels of the held-out fold change nothing.
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in score_quality(docs, flipped).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in scored.collect())
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == scored.where("predicted = 1").count()


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(1)
    h = lambda x: np.histogram(x, 400, (0, 1))[0]
    positive, negative = rng.beta(5, 2, 20000), rng.beta(1, 8, 20000)
    for share in (0.5, 0.8, 0.95):
        mixed = np.concatenate([rng.beta(5, 2, int(20000 * share)), negative[:int(20000 * (1 - share))]])
        assert abs(prior_from_histograms(h(positive), h(mixed)) - share) < 0.05


def test_edges(spark, docs_of):
    pairs = [(i, f"fine words number {i} in a row") for i in range(40)] + [(None, None), (50, ""), (51, None), (3, "again"), (52, "w " * 100000)]
    df = docs_of(pairs, score="mine", _x=1, predicted="p")
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(40)] + [(None, 1, 0), (7, None, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    out = score_quality(df, labels).collect()
    assert len(out) == len(pairs) and all(0 <= r["score"] <= 1 for r in out)
    assert [r["held_out"] for r in out if r["doc_id"] is None] == [False]
    assert keep_quality(df, labels).columns == df.columns
    none = labels.where("false")
    assert {r["score"] for r in score_quality(df, none).collect()} == {1.0}
    assert keep_quality(df, none).count() == len(pairs)
    assert score_quality(docs_of([]), labels).count() == 0
    assert len(quality.text_features(b"")) == len(quality.FEATURES)


def test_sample_of_mostly_null_and_repeated_ids(spark):
    """Rows that share an id have the sample's share, not the whole sample."""
    from pyspark.sql import functions as F
    x = F.array_repeat(F.col("kind").cast("double"), len(quality.FEATURES))
    for shared in ("null", "0"):
        rows = spark.range(6000).selectExpr("id", "int(id % 2) kind").selectExpr(f"if(kind = 0, {shared}, id) _id", "kind", "id _rid").select("_id", "_rid", x.alias("_x"))
        got = quality._sample(rows, 1000)[:, 0]
        assert len(got) == 1000 and 400 < got.sum() < 600


def test_scores_with_more_null_ids_than_the_sample(spark, docs_of):
    good = lambda i: f"The committee met on day {i} and agreed to review the plan. A report follows in the spring."
    junk = lambda i: f"$$$ BUY !!! {i} ### | | | 50% CHEAP!!! @@@ {i}"
    # null ids are junk, the others good
    df = docs_of([(None, junk(i)) for i in range(900)] + [(i, good(i)) for i in range(600)])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 600, 2)], "doc_id long, quality int, toxic int")
    seen = written(quality.feature_table(df, "doc_id", "text"), "test-features")
    sample = quality._sample(seen, 300)
    bangs = quality.FEATURES.index("bangs")
    assert 120 < (sample[:, bangs] > 0).sum() < 240
    assert seen.select("_rid").distinct().count() == 1500
    out = score_quality(df, labels, max_fit_rows=300).collect()
    assert sum(r["predicted"] == (r["doc_id"] is not None) for r in out) > 0.98 * len(out)


def test_scores_do_not_depend_on_the_layout(spark, docs_of):
    """More rows than the samples hold, copies and null ids among them."""
    good, bad = "The quiet river runs past the old mill and on to the sea.", "CLICK!!! >>> $$$ 000 !!! buy"
    pairs = [(i if i % 7 else None, f"{good if i % 2 else bad} {i % 50}" * (1 + i % 3)) for i in range(900)] + [(5, good)] * 40 + [(None, None)] * 30
    labels = spark.createDataFrame([(i, 1, 0) for i in range(1, 900, 2) if i % 7], "doc_id long, quality int, toxic int")
    df = docs_of(pairs)
    seen = [sorted((tuple(r) for r in quality.score_quality(df.repartition(n, *by), labels, max_fit_rows=200).collect()), key=str)
            for n, by in ((1, []), (7, []), (4, ["text"]))]
    assert seen[0] == seen[1] == seen[2]
    assert len({r[2] for r in seen[0]}) > 10
