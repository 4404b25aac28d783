"""Toxicity classifier: held-out accuracy, the trees, calibration and edges."""

from __future__ import annotations

import numpy as np
import pytest

from unitmesh.llm import toxicity
from unitmesh.llm.toxicity import Lexicon, fit_trees, isotonic, score_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_no_label_leak(spark):
    from pyspark.sql import functions as F
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_toxicity(docs, labels).cache()
    assert scored.count() == docs.count()
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    y = np.array([r["toxic"] for r in rows])
    p = np.array([r["predicted"] for r in rows])
    assert (p == y).mean() > 0.98 and p[y == 1].mean() > 0.9 and p[y == 0].mean() < 0.01
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in score_toxicity(docs, flipped).collect()}
    assert all(abs(again[r["doc_id"]] - r["score"]) < 1e-9 for r in scored.collect())


def test_trees_learn_an_interaction_and_isotonic_rises():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = fit_trees(x, y)
    assert ((model.margin(model.bins(x)) > 0) == y).mean() > 0.97
    points, values = isotonic(np.array([0, 1, 1, 2, 3.0]), np.array([0, 1, 0, 0, 1.0]))
    assert (np.diff(points) > 0).all() and (np.diff(values) > 0).all()
    assert values.tolist() == pytest.approx([0, 1 / 3, 1])


def test_features_of_obfuscated_and_second_person_text():
    lexicon = Lexicon({"idiot": 5.0, "loser": 4.0}, {"idio-": 3.0})
    at = {n: k for k, n in enumerate(toxicity.FEATURES)}
    x = lexicon.features("You are an IDIOT, you l0ser! 1d10t sh*** stuuuupid f.o.o.l")
    assert x[at["word_density"]] > 0 and x[at["near_second_person"]] > 0 and x[at["obfuscated_hits"]] == 2
    assert x[at["masked"]] > 0 and x[at["stretched"]] > 0 and x[at["shouted_words"]] > 0 and x[at["digit_inside"]] > 0
    assert len(lexicon.features("")) == len(toxicity.FEATURES)
    assert lexicon.features("plain words") == lexicon.features("plain words")


def test_edges(spark, docs_of):
    pairs = [(i, "you utter fool and clown" if i % 3 == 0 else f"good day number {i}") for i in range(60)]
    pairs += [(None, None), (70, ""), (71, None), (3, "again"), (72, "w " * 100000)]
    df = docs_of(pairs, score="mine", _y=1)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(60)] + [(None, 1, 1), (5, 1, None), (999, 0, 1), (6, 1, 7)],
                                   "doc_id long, quality int, toxic int")
    out = score_toxicity(df, labels).collect()
    assert len(out) == len(pairs) and all(0 <= r["score"] <= 1 for r in out)
    assert {r["score"] for r in score_toxicity(df, labels.where("toxic = 0")).collect()} == {0.0}
    assert {r["predicted"] for r in score_toxicity(df, labels.where("false")).collect()} == {0}
    assert score_toxicity(docs_of([]), labels).count() == 0


def test_lexicon_counts_rows_beyond_the_fit_sample(spark, docs_of):
    # 1,000 labelled rows, of which the trees see 60; two rare terms in 20 toxic rows each
    text = lambda i: f"you {('zounds', 'blaggard')[i // 5 % 2]} there" if i % 25 == 0 else f"good day number {i}"
    df = docs_of([(i, text(i)) for i in range(1000)])
    labels = spark.createDataFrame([(i, 1, int(i % 25 == 0)) for i in range(1000)], "doc_id long, quality int, toxic int")
    model = toxicity.fit_toxicity(df, labels, max_fit_rows=60)
    assert {"zounds", "blaggard"} <= set(model.lexicon.words)
    whole = toxicity.fit_toxicity(df, labels)
    assert model.lexicon.words == whole.lexicon.words and model.lexicon.beginnings == whole.lexicon.beginnings
