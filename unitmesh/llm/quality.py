"""Positive-unlabelled quality classifier.

Trusted positives (documents labelled good, of the training folds) and unlabelled text
(all documents of the training folds, their labels unused) train an additive model on
dense text features by minimising the non-negative unbiased risk

    prior * E_P[loss(g, +1)] + max(0, E_U[loss(g, -1)] - prior * E_P[loss(g, -1)]).

The class prior is estimated first: positive-against-unlabelled models (cross-fitted on
halves) rank all documents, Spark counts a histogram of the scores over *all* unlabelled
documents, and
the prior is the smallest ratio of the unlabelled to the positive upper tail (beyond
junk scores only positives are left, and the ratio of the tails is their share).

Features are computed once per document over its whole text, in Arrow batches. Only the
fit runs on the driver, on at most ``max_fit_rows`` positives and as many unlabelled
rows (those with the smallest hash of their row number, as an id may be null or repeat);
prior and scores cover every row.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from unitmesh.operators.numbering import row_numbers
from unitmesh.llm.common import byte_class, col, hash_sample, packed, ready, unpacked, written

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
MAX_FIT_ROWS = 20_000
FEATURES = ("log_words", "symbols", "bars", "bangs", "upper", "digits", "punctuation", "spaces", "breaks",
            "non_ascii", "distinct_words", "same_as_last", "word_length", "repeated_lines", "compressed")
_BINS = 16
_STEPS = 400
_RIDGE, _SMOOTH = 0.5, 4.0
_HISTOGRAM = 400


# Byte classes; rows of a 256-column matrix, so one product gives all counts of a text.
_CLASSES = np.stack([
    byte_class(b"#$%&*@^~=+<>{}[]\\_/"), byte_class(b"|"), byte_class(b"!"), byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    byte_class(b"0123456789"), byte_class(b".,;:?'\"()-"), byte_class(b" \t"), byte_class(b"\n"), byte_class(bytes(range(128, 256)))])


def text_features(text: bytes) -> np.ndarray:
    """The features of one whole UTF-8 text."""
    n = max(len(text), 1)
    shares = _CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / n
    words = text.split()
    k = max(len(words), 1)
    lines = [x for x in text.split(b"\n") if x]
    return np.concatenate([[np.log1p(len(words))], shares, [
        len(set(words)) / k, sum(map(eq, words, words[1:])) / k, min(len(text) / k, 200.0),
        1 - len(set(lines)) / max(len(lines), 1), len(zlib.compress(text, 1)) / n]])


def _matrix(column: pa.Array) -> np.ndarray:
    texts = column.cast(pa.binary()).to_pylist()
    return np.stack([text_features(t or b"") for t in texts]) if texts else np.zeros((0, len(FEATURES)))


@dataclass
class AdditiveModel:
    """One weight for each feature and quantile bin."""

    edges: np.ndarray  # features x (bins - 1)
    weights: np.ndarray  # features x bins
    bias: float
    prior: float = 1.0

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(self.edges[j], x[:, j], side="right") for j in range(x.shape[1])], axis=1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        return self.bias + sum((self.weights[j][bins[:, j]] for j in range(bins.shape[1])), np.zeros(len(bins)))

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(self.bins(x)), -30, 30)))


def _blank(p: np.ndarray, u: np.ndarray) -> AdditiveModel:
    both = np.concatenate([p, u])
    q = np.linspace(0, 1, _BINS + 1)[1:-1]
    # Half of the edges from all rows, half from the rows' extremes, where junk lies.
    tails = np.concatenate([q ** 3, 1 - q ** 3])
    edges = np.quantile(both, np.sort(np.concatenate([q, tails])), axis=0).T
    return AdditiveModel(edges, np.zeros((both.shape[1], edges.shape[1] + 1)), 0.0)


def _descend(model: AdditiveModel, p: np.ndarray, u: np.ndarray, slopes) -> AdditiveModel:
    """Adam on the weights; ``slopes(gp, gu)`` gives the risk's derivative by each row's margin."""
    bp, bu = model.bins(p), model.bins(u)
    both, (d, k) = np.concatenate([bp, bu]), model.weights.shape
    flat = both + np.arange(d) * k
    theta, m, v = np.zeros(d * k + 1), np.zeros(d * k + 1), np.zeros(d * k + 1)
    for step in range(1, _STEPS + 1):
        g = theta[flat].sum(axis=1) + theta[-1]
        s = slopes(g[:len(bp)], g[len(bp):])
        grad = np.append(np.bincount(flat.ravel(), np.repeat(s, d), d * k), s.sum())
        # A prior worth some rows: small weights, and alike in neighbouring bins.
        w = theta[:-1].reshape(d, k)
        rough = np.zeros_like(w)
        rough[:, 1:] += np.diff(w, axis=1)
        rough[:, :-1] -= np.diff(w, axis=1)
        grad[:-1] += ((_RIDGE * w + _SMOOTH * rough) / min(len(bp), len(bu))).ravel()
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta -= 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)
    return AdditiveModel(model.edges, theta[:-1].reshape(d, k), float(theta[-1]), model.prior)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_ranker(p: np.ndarray, u: np.ndarray) -> AdditiveModel:
    """Positives against unlabelled by the logistic loss."""
    return _descend(_blank(p, u), p, u, lambda gp, gu: np.concatenate(
        [-_sigmoid(-gp) / len(gp), _sigmoid(gu) / len(gu)]))


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float) -> AdditiveModel:
    """Non-negative unbiased risk, logistic loss. Where the estimated risk of the
    negatives falls below zero, the step climbs back on that part only."""
    def slopes(gp, gu):
        neg_u, neg_p = _sigmoid(gu) / len(gu), _sigmoid(gp) / len(gp)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        if negative < 0:
            return np.concatenate([prior * neg_p, -neg_u])
        return np.concatenate([prior * -_sigmoid(-gp) / len(gp) - prior * neg_p, neg_u])

    model = _blank(p, u)
    model.prior = prior
    return _descend(model, p, u, slopes)


def prior_from_histograms(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Counts by score bin, lowest first. The ratio of the unlabelled to the positive upper
    tail where its upper confidence bound is smallest (small tails are too noisy)."""
    n_p, n_u = max(positive.sum(), 1), max(unlabelled.sum(), 1)
    tp, tu = positive[::-1].cumsum() / n_p, unlabelled[::-1].cumsum() / n_u
    slack = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(n_p) + 1 / np.sqrt(n_u))
    far = tp > 0
    if not far.any():
        return 1.0
    best = ((tu[far] + slack) / tp[far]).argmin()
    return float(np.clip(tu[far][best] / tp[far][best], 0.01, 1.0))


# ------------------------------------------------------------------ Spark side
def held_out(id_col, folds: int, fold: int):
    """crc32 of the id as text, by folds; a null id is in a training fold."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == fold, F.lit(False))


def feature_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``_id``, ``_x``: features, ``_rid``) of every row. ``_rid`` is the row's content
    (a hash of id and text) and its number among rows of equal content. Such rows are
    interchangeable, so what is sampled by ``_rid`` does not depend on how the table is
    laid out, and copies have no more than their share of a sample."""
    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x), pa.list_(pa.float64())), batch.column(2)], names=["_id", "_x", "_content"])

    out = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_x", T.ArrayType(T.DoubleType())), T.StructField("_content", T.StringType())])
    text = col(text_col).cast("string")
    content = F.md5(F.concat_ws("\x00", col(id_col).cast("string"), F.hex(F.octet_length(text)), text).cast("binary"))
    made = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"), content.alias("_content")).mapInArrow(run, out)
    made = written(made.withColumn("_at", F.monotonically_increasing_id()), "quality-rows")
    numbered = row_numbers(made, ["_content"], ["_at"], out="_n")
    return numbered.select("_id", "_x", F.concat_ws(":", "_content", F.col("_n").cast("string")).alias("_rid"))


def _sample(rows: DataFrame, n: int) -> np.ndarray:
    got = hash_sample(rows, "_rid", n).select("_x").toArrow().column(0).to_pylist()
    return np.array(got, float).reshape(len(got), len(FEATURES))


def _scores(table: DataFrame, model, extra: list[str]) -> DataFrame:
    """``extra`` columns and ``_score`` of a feature table."""
    def run(batches):
        for batch in batches:
            x = np.array(batch.column(0).to_pylist(), float).reshape(batch.num_rows, len(FEATURES))
            s = model.score(x) if model and batch.num_rows else np.ones(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(s)], names=[*extra, "_score"])

    out = T.StructType([table.schema[c] for c in extra] + [T.StructField("_score", T.DoubleType())])
    return table.select("_x", *extra).mapInArrow(run, out)


def fit_quality(table: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                max_fit_rows: int = MAX_FIT_ROWS) -> AdditiveModel | None:
    """Fit on a written feature table. None without any trusted positive."""
    positives = (labels.select(col(id_col).alias("_id"), col(label_col).alias("_y")).where("_y is not null")
                 .groupBy("_id").agg(F.min("_y").alias("_y")).where("_y = 1").select("_id"))
    train = table.where(~held_out(F.col("_id"), FOLDS, HELD_OUT))
    good = written(train.join(positives, "_id"), "quality-positives")
    p, u = _sample(good, max_fit_rows), _sample(train, max_fit_rows)
    if not len(p) or not len(u):
        return None
    return fit_nnpu(p, u, class_prior(good, train, max_fit_rows))


def class_prior(good: DataFrame, train: DataFrame, max_fit_rows: int) -> float:
    """The share of positives among all rows of ``train``. Each half of the rows (by a
    hash of its content and number) is ranked by a model fitted on the other half, so that no row's
    score comes from its own fit; the histograms cover every row."""
    half = F.pmod(F.xxhash64("_rid", F.lit("half")), F.lit(2))
    level = F.least(F.floor(F.col("_score") * _HISTOGRAM), F.lit(_HISTOGRAM - 1)).cast("int")
    totals = []
    for side in (0, 1):
        p, u = (_sample(rows.where(half != side), max_fit_rows // 2) for rows in (good, train))
        if not len(p) or not len(u):
            return 1.0
        ranker = fit_ranker(p, u)
        for rows in (good, train):
            out = np.zeros(_HISTOGRAM)
            for r in _scores(rows.where(half == side), ranker, []).groupBy(level.alias("_level")).count().collect():
                out[r["_level"]] = r["count"]
            totals.append(out)
    return prior_from_histograms(totals[0] + totals[2], totals[1] + totals[3])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """(id, ``held_out``, ``score``, ``predicted``) for every row of ``docs``.

    Labels count only from rows whose crc32(id as text) mod 4 is not 2, only as trusted
    positives, and never enter a score; language, source and id don't either. Null and
    empty texts have the features of an empty text and are scored like any other. An id
    labelled both ways is no trusted positive; null labels and labels of unknown ids are
    ignored. Without any trusted positive nothing can be learnt and every score is 1.
    Rows that repeat an id each get their score. An empty table gives an empty table. The
    scores do not depend on the order or the partitions of the rows.
    """
    ready(docs.sparkSession)
    table = written(feature_table(docs, id_col, text_col), "quality-features")
    model = fit_quality(table, labels, id_col, max_fit_rows=max_fit_rows)
    return _scores(table, model, ["_id"]).select(
        F.col("_id").alias(id_col), held_out(F.col("_id"), FOLDS, HELD_OUT).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, unchanged. The fit is
    that of :func:`score_quality`; every row is then judged by its own text in one pass
    without a shuffle."""
    ready(docs.sparkSession)
    table = written(feature_table(docs, id_col, text_col), "quality-features")
    model = fit_quality(table, labels, id_col, max_fit_rows=max_fit_rows)
    if model is None:
        return docs
    parts = {"_text": text_col}
    rows = packed(docs, parts)

    def run(batches):
        for batch in batches:
            good = model.score(_matrix(batch.column(0))) >= threshold if batch.num_rows else np.zeros(0, bool)
            yield batch.filter(pa.array(good))

    return unpacked(rows.mapInArrow(run, rows.schema), docs, parts, {})
