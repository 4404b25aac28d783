"""Every stage of the pipeline against a plain version of it on the stage's own input."""

from __future__ import annotations

import pytest
from llm.test_decontam import slow as slow_contamination
from llm.test_line_dedup import slow as slow_lines
from llm.test_simhash import slow_components, slow_fingerprint

import corpus_pipeline
from unitmesh.llm.common import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input and output of each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        made = written(stage(spark, docs, SF), name)
        out[name] = (docs, made)
        docs = made
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "simhash", "decontamination", "packing"]
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == before.columns and after.schema == before.schema


def test_quality_keeps_rows_unchanged(stages):
    before, after = stages["quality"]
    assert 0 < after.count() < before.count()
    assert set(pairs(after)) <= set(pairs(before))


def test_line_dedup(stages):
    before, after = stages["line_dedup"]
    assert sorted(pairs(after)) == sorted((i, t) for i, t, _, _ in slow_lines(pairs(before)))
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_simhash_keeps_one_of_each_group(stages):
    before, after = stages["simhash"]
    nodes = pairs(before)
    ids = slow_components([(i, slow_fingerprint(t)) for i, t in nodes])
    assert sorted(i for i, _ in pairs(after)) == sorted(set(ids))


def test_decontamination(spark, stages):
    before, after = stages["decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(i for i, _ in pairs(after)) == sorted(r[0] for r in slow_contamination(pairs(before), items) if not r[4])


def test_packing_holds_every_word(stages):
    before, after = stages["packing"]
    want = {i: len((t or "").split()) for i, t in pairs(before)}
    got = {r["doc_id"]: r["n"] for r in after.groupBy("doc_id").sum("n_words").withColumnRenamed("sum(n_words)", "n").collect()}
    assert got == want


def test_one_row_of_rows_equal_in_id_and_text(spark, docs_of):
    from unitmesh.llm.simhash import keep_one_of_each

    df = docs_of([(1, "a b c d"), (1, "a b c d"), (2, "a b c d"), (None, None), (None, ""), (None, "x y z w"), (5, "x y z w")])
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=str) == [(1, "a b c d"), (5, "x y z w"), (None, "")]


def test_run_equals_the_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages["packing"][1].count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_keeps_what_the_classifier_predicts(spark, stages):
    from pyspark.sql import functions as F

    from unitmesh.llm.quality import score_quality

    before, after = stages["quality"]
    good = score_quality(before, spark.read.parquet(f"{SF}/labels.parquet")).where(F.col("predicted") == 1)
    ids = {r["doc_id"] for r in good.collect()}
    assert sorted(pairs(after)) == sorted(p for p in pairs(before) if p[0] in ids)


def test_packing_rows(stages):
    from llm.test_packing import rows_of, slow_pack

    from unitmesh.llm.packing import CAPACITY, SHARD_ROWS

    before, after = stages["packing"]
    docs = [(r["doc_id"], r["text"], r["source"]) for r in before.collect()]
    assert len(docs) <= SHARD_ROWS
    assert sorted(rows_of(after)) == slow_pack(docs, CAPACITY)


def test_rows_of_run_are_those_of_the_stages(spark, stages):
    run, made = corpus_pipeline.run(spark, SF), stages["packing"][1]
    assert run.schema == made.schema
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, made.collect()))
