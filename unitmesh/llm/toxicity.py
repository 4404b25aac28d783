"""Toxicity classifier: gradient-boosted trees over dense features, isotonic calibration.

Trees and calibration are fitted on at most ``max_fit_rows`` labelled rows of the training
folds. The lexicon is learnt, not listed: Spark counts in how many toxic and other of all
labelled documents of these folds each word and each word beginning occurs, and the terms
with the strongest evidence are kept, at most ``max_terms``. The dense features of a text are the densities
of these terms, how near they stand to a second person, capitals, punctuation and
obfuscation rates. The trees are fitted on the driver; every row is scored.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from unitmesh.llm.common import byte_class, col, hash_sample, ready, written
from unitmesh.llm.quality import held_out

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
MAX_FIT_ROWS = 30_000
MAX_TERMS = 400
MIN_TOXIC_DOCUMENTS = 5
FEATURES = ("word_density", "word_weight", "beginning_density", "beginning_weight", "log_hits", "distinct_terms",
            "near_second_person", "second_person", "upper", "shouted_words", "bangs", "questions", "punctuation",
            "digit_inside", "masked", "stretched", "obfuscated_hits", "log_words")
# Words that address the reader (English, French, German, Spanish).
_YOU = frozenset("you your yours yourself u ur youre tu toi te ton ta tes vous votre vos du dich dir dein deine "
                 "ihr euch sie usted ustedes tú ti tus vosotros".split())
# Characters written in place of letters.
_LEET = str.maketrans("0134578@$!|", "oieastbasil")
_WORD = re.compile(r"[^\W_]+")
_LEET_INSIDE = re.compile(r"[^\W\d_][0134578@$!|]+[^\W\d_]|^[0134578@$!|]+[^\W\d_]{2}")
_MASKED = re.compile(r"[^\W\d_]+[*#%&$@]{2,}[^\W\d_]|[^\W\d_](?:[.\-_*][^\W\d_]){3,}")
_STRETCHED = re.compile(r"([^\W\d_])\1{3,}")
_NEAR = 6
_CLASSES = np.stack([byte_class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), byte_class(b"!"), byte_class(b"?"), byte_class(b".,;:'\"()-")])


def terms_of(words) -> set[str]:
    """The words and their beginnings (marked with a final dash) of a text."""
    out = set(words)
    for w in list(out):
        if len(w) > 5:
            out.add(w[:4] + "-")
            out.add(w[:5] + "-")
    return out


class Lexicon:
    """The learnt terms (term to log-odds) and what each token of a text adds to the
    features. Token results are kept, since few distinct tokens make up most of a text."""

    KEPT = 200_000

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.words, self.beginnings = words, beginnings
        self._known: dict[str, tuple | None] = {}

    def _parts(self, token: str) -> tuple | None:
        """(hits, weight, begun, begun weight, second person, digit inside, masked,
        stretched, unmasked, term) of a lower-case token; None if it adds nothing."""
        hits = weight = begun = begun_weight = you = 0
        term = None
        core = token.strip(".,;:?!\"'()")
        plain_word = core.isalpha()
        if plain_word and core not in self.words and core not in _YOU and not _STRETCHED.search(core) and not (
                len(core) > 5 and (core[:4] + "-" in self.beginnings or core[:5] + "-" in self.beginnings)):
            return None
        for w in [core] if plain_word else _WORD.findall(token):
            v = self.words.get(w)
            if v is not None:
                hits, weight, term = hits + 1, weight + v, w
            if len(w) > 5:
                v = max(self.beginnings.get(w[:4] + "-", 0.0), self.beginnings.get(w[:5] + "-", 0.0))
                if v:
                    begun, begun_weight, term = begun + 1, begun_weight + v, term or w[:4]
            you += w in _YOU
        digit = bool(_LEET_INSIDE.search(core)) and any(map(str.isalpha, core))
        plain = core.translate(_LEET) if digit else ""
        unmasked = int(plain in self.words)
        masked, stretched = bool(_MASKED.search(core)), bool(_STRETCHED.search(core))
        if not (hits or begun or you or digit or masked or stretched):
            return None
        return hits, weight, begun, begun_weight, you, int(digit), int(masked), int(stretched), unmasked, term

    def features(self, text: str) -> list[float]:
        """The features of one whole text."""
        raw = text.encode()
        n = max(len(raw), 1)
        upper, bangs, questions, punctuation = (_CLASSES @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / n).tolist()
        tokens = text.lower().split()
        k = max(len(tokens), 1)
        sums, kinds, known = [0.0] * 9, set(), self._known
        for token, times in Counter(tokens).items():
            parts = known.get(token, 0)
            if parts == 0:
                parts = self._parts(token)
                if len(known) >= self.KEPT:
                    known.clear()
                if len(token) <= 64:
                    known[token] = parts
            if parts is not None:
                sums = [x + y * times for x, y in zip(sums, parts)]
                if parts[9]:
                    kinds.add(parts[9])
        hits, weight, begun, begun_weight, you, digit, masked, stretched, unmasked = sums
        near = self._near(tokens) if kinds and you else 0
        shouted = sum(1 for w in text.split() if len(w) > 2 and w.isupper()) if upper > 0.03 else 0
        return [hits / k, weight / k, begun / k, begun_weight / k, float(np.log1p(hits + begun)), float(len(kinds)), near / k,
                you / k, upper, shouted / k, bangs, questions, punctuation, digit / k, masked / k, stretched / k,
                unmasked, float(np.log1p(len(tokens)))]

    def _near(self, tokens: list[str]) -> int:
        """Terms with a second person within a few words."""
        said = [(i, p) for i, t in enumerate(tokens) if (p := self._known[t] if t in self._known else self._parts(t))]
        persons = np.array([i for i, p in said if p[4]])
        places = np.array([i for i, p in said if p[9]])
        at = np.searchsorted(persons, places)
        gap = np.minimum(np.abs(persons[np.minimum(at, len(persons) - 1)] - places),
                         np.abs(persons[np.maximum(at - 1, 0)] - places))
        return int((gap <= _NEAR).sum())


# ------------------------------------------------------------------ trees
@dataclass
class Boosted:
    """Trees of fixed depth on binned features; nodes in heap order."""

    edges: list[np.ndarray]
    trees: list[tuple] = field(default_factory=list)  # (feature, bin, leaf values)
    base: float = 0.0
    depth: int = 3

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(bins), self.base), np.arange(len(bins))
        for feature, cut, value in self.trees:
            node = np.zeros(len(bins), int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (bins[rows, feature[node]] > cut[node])
            out += value[node - (2 ** self.depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.2, depth: int = 3, bins: int = 32) -> Boosted:
    """Newton boosting of the logistic loss with histogram splits."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    extra = [np.unique(np.quantile(c[c > 0], np.linspace(0, 1, bins // 2)[:-1])) if (c := x[:, j]).max(initial=0) > 0 else [] for j in range(x.shape[1])]
    edges = [np.unique(np.concatenate([e, f])) for e, f in zip(edges, extra)]
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(edges, base=float(np.log(rate0 / (1 - rate0))), depth=depth)
    b, wide = model.bins(x), max(len(e) for e in edges) + 1
    d, margin, inner = x.shape[1], np.full(len(y), model.base), 2 ** depth - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(inner, int), np.full(inner, wide)
        node = np.zeros(len(y), int)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.zeros(width)
            for j in range(d):
                at = (node - first) * wide + b[:, j]
                g = np.bincount(at, grad, width * wide).reshape(width, wide).cumsum(axis=1)
                h = np.bincount(at, hess, width * wide).reshape(width, wide).cumsum(axis=1)
                gt, ht = g[:, -1:], h[:, -1:]
                gain = g ** 2 / (h + 1) + (gt - g) ** 2 / (ht - h + 1) - gt ** 2 / (ht + 1)
                gain[(h < 1) | (ht - h < 1)] = 0
                k = gain.argmax(axis=1)
                better = gain[np.arange(width), k] > best + 1e-9
                best = np.where(better, gain[np.arange(width), k], best)
                feature[first:first + width] = np.where(better, j, feature[first:first + width])
                cut[first:first + width] = np.where(better, k, cut[first:first + width])
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, 2 ** depth), np.bincount(leaf, hess, 2 ** depth)
        value = -rate * g / (h + 1)
        model.trees.append((feature, cut, value))
        margin += value[leaf]
    return model


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: margins (first of each block) and calibrated values."""
    order = np.argsort(margin, kind="stable")
    # equal margins are one point
    m, start = np.unique(margin[order], return_index=True)
    total = np.add.reduceat(y[order].astype(float), start)
    size = np.diff(np.append(start, len(y))).astype(float)
    blocks: list[list[float]] = []
    for at, s, n in zip(m, total, size):
        blocks.append([at, s, n])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            _, s2, n2 = blocks.pop()
            blocks[-1][1] += s2
            blocks[-1][2] += n2
    return np.array([x[0] for x in blocks]), np.array([x[1] / x[2] for x in blocks])


@dataclass
class ToxicityModel:
    lexicon: Lexicon
    trees: Boosted
    points: np.ndarray
    values: np.ndarray

    def features(self, texts: list[str]) -> np.ndarray:
        return np.array([self.lexicon.features(t) for t in texts], float).reshape(len(texts), len(FEATURES))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability, with a little of the trees' own order inside each
        isotonic step so that equal steps still rank."""
        margin = self.trees.margin(self.trees.bins(x))
        step = self.values[np.clip(np.searchsorted(self.points, margin, side="right") - 1, 0, len(self.values) - 1)]
        return np.clip(0.98 * step + 0.02 / (1 + np.exp(-np.clip(margin, -30, 30))), 0, 1)


def fit_model(lexicon: Lexicon, x: np.ndarray, y: np.ndarray) -> ToxicityModel:
    """Trees on all rows; calibration on out-of-fold margins (three folds by row order)."""
    out, fold = np.zeros(len(y)), np.arange(len(y)) % 3
    for k in range(3):
        if (fold != k).any() and (fold == k).any():
            part = fit_trees(x[fold != k], y[fold != k])
            out[fold == k] = part.margin(part.bins(x[fold == k]))
    return ToxicityModel(lexicon, fit_trees(x, y), *isotonic(out, y))


# ------------------------------------------------------------------ Spark side
_FLUSH = 200_000


def _term_batches(batches):
    """(term, toxic documents, documents), summed over many rows of a task."""
    seen: dict[str, list[int]] = {}

    def flush():
        rows = pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()),
                                           pa.array([v[1] for v in seen.values()], pa.int64())], names=["_term", "_toxic", "_all"])
        seen.clear()
        return rows

    for batch in batches:
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for term in terms_of(_WORD.findall((text or "").lower())):
                at = seen.setdefault(term, [0, 0])
                at[0] += y
                at[1] += 1
        if len(seen) > _FLUSH:
            yield flush()
    if seen:
        yield flush()


def learn_lexicon(labelled: DataFrame, max_terms: int, min_toxic: int) -> Lexicon:
    """Words and beginnings that occur in far more toxic documents than their share:
    highest z-score against the toxic rate, of those with log-odds above 2."""
    counts = labelled.select("_text", "_y").mapInArrow(_term_batches, "_term string, _toxic long, _all long")
    terms = counts.groupBy("_term").agg(F.sum("_toxic").alias("a"), F.sum("_all").alias("n"))
    total = labelled.agg(F.sum("_y").alias("a"), F.count(F.lit(1)).alias("n")).first()
    toxic, other = float(total["a"] or 0), float(total["n"] - (total["a"] or 0))
    if not toxic or not other:
        return Lexicon({}, {})
    rate, b = toxic / (toxic + other), F.col("n") - F.col("a")
    odds = F.log((F.col("a") + 0.5) / (F.lit(toxic) - F.col("a") + 0.5)) - F.log((b + 0.5) / (F.lit(other) - b + 0.5))
    z = (F.col("a") - F.col("n") * rate) / F.sqrt(F.col("n") * rate * (1 - rate))
    best = (terms.where(F.col("a") >= min_toxic).withColumn("odds", odds).withColumn("z", z).where("z >= 4 and odds > 2")
            .orderBy(F.desc("z"), "_term").limit(max_terms).select("_term", "odds").collect())
    found = {r["_term"]: r["odds"] for r in best}
    return Lexicon({t: v for t, v in found.items() if not t.endswith("-")}, {t: v for t, v in found.items() if t.endswith("-")})


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(``_id``, ``_text``, ``_y``) of every labelled id of the training folds that
    ``docs`` has, written. The texts of a repeated id become one before they move."""
    ys = (labels.select(col(id_col).alias("_id"), col(label_col).cast("int").alias("_y")).where("_y in (0, 1)")
          .where(~held_out(F.col("_id"), FOLDS, HELD_OUT)).groupBy("_id").agg(F.max("_y").alias("_y")))
    texts = (docs.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
             .where(~held_out(F.col("_id"), FOLDS, HELD_OUT)).groupBy("_id").agg(F.min("_text").alias("_text")))
    return written(texts.join(ys, "_id").select("_id", "_text", "_y"), "toxicity-labelled")


def labelled_sample(labelled: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` of the labelled rows, those with the smallest hash of their id.
    The chosen ids (a bounded number) are sent to the texts, which do not move."""
    chosen = written(hash_sample(labelled.select("_id"), "_id", rows), "toxicity-ids")
    return labelled.join(F.broadcast(chosen), "_id")


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", max_fit_rows: int = MAX_FIT_ROWS, max_terms: int = MAX_TERMS,
                 min_toxic: int = MIN_TOXIC_DOCUMENTS) -> ToxicityModel | None:
    """The lexicon from all labelled rows of the training folds, trees and calibration from
    at most ``max_fit_rows`` of them. None unless both labels occur among these."""
    ready(docs.sparkSession)
    labelled = labelled_rows(docs, labels, id_col, text_col, label_col)
    lexicon = learn_lexicon(labelled, max_terms, min_toxic)

    def run(batches):
        for batch in batches:
            x = [lexicon.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["_x", "_y", "_id"])

    out = T.StructType([T.StructField("_x", T.ArrayType(T.DoubleType())), T.StructField("_y", T.IntegerType()), labelled.schema["_id"]])
    rows = labelled_sample(labelled, max_fit_rows).select("_text", "_y", "_id").mapInArrow(run, out).orderBy(F.xxhash64("_id"), "_id").select("_x", "_y").toArrow()
    x, y = np.array(rows.column(0).to_pylist(), float), np.array(rows.column(1).to_pylist(), float)
    if not len(y) or not 0 < y.sum() < len(y):
        return None
    return fit_model(lexicon, x.reshape(len(y), len(FEATURES)), y)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD, max_fit_rows: int = MAX_FIT_ROWS) -> DataFrame:
    """(id, ``held_out``, ``score``, ``predicted``) for every row of ``docs``.

    Labels count only from rows whose crc32(id as text) mod 3 is not 1 and never enter a
    score; language, source and id don't either. An id labelled both ways counts as
    toxic; labels other than 0 and 1 and labels of unknown ids are ignored. Null and
    empty texts are scored like any other text without words. Unless both labels occur
    nothing can be learnt and every score is 0. Rows that repeat an id each get their
    score. An empty table gives an empty table. Extra columns are not read.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, max_fit_rows=max_fit_rows)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            s = model.score(model.features(texts)) if model and texts else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s, pa.float64())], names=["_id", "_score"])

    out = T.StructType([T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_score", T.DoubleType())])
    scored = docs.select(col(id_col).alias("_id"), col(text_col).alias("_text")).mapInArrow(run, out)
    return scored.select(F.col("_id").alias(id_col), held_out(F.col("_id"), FOLDS, HELD_OUT).alias("held_out"),
                         F.col("_score").alias("score"), (F.col("_score") >= threshold).cast("int").alias("predicted"))
