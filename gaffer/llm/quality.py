"""Quality classifier by positive-unlabelled learning.

Trusted positives are the labelled good texts; the unlabelled set is plain web
text from the documents; labelled bad texts are never used as negatives. With
class prior p, the model minimises the non-negative unbiased risk

    p * R+(positives)  +  max(0, R-(unlabelled) - p * R-(positives))

where R+ and R- are mean sigmoid losses towards either class (bounded, so that a few
confident texts don't outweigh the rest). When the second part falls below zero
the model has overfitted, and a step raises it again, by a discounted gradient.

The prior is estimated, not given: a first model is fitted to tell positives
from unlabelled on one half of the sample; on the other half the best-bin bound,
min over thresholds of (share of unlabelled above) / (share of positives above),
with confidence margins, estimates which share of the unlabelled is positive.

The model is additive over quantile bins of dense text features (``FEATURES``)
and over pairs of the features' bins with word count, so a score is a plain sum
of learnt bin weights; scores are the sigmoid of the sum.

Bounded: at most ``MAX_POSITIVES`` positives and ``MAX_UNLABELLED`` unlabelled rows
are learnt from, those least by a hash of their id. Scoring has no bound.

Defined cases: a null text scores like an empty one; null labels teach nothing;
contradicting labels of a doc_id make it no trusted positive; without positives
every score is 0.5, without unlabelled rows it is 1; a null doc_id is scored and
counts as not held out; repeated rows are scored each; columns other than
doc_id and text are ignored.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import in_holdout

MAX_POSITIVES = 12_000
MAX_UNLABELLED = 24_000
BINS = 24
STEPS = 400
RATE = 0.05
RIDGE = 1e-4
DISCOUNT = 0.2
FEATURES = ("log_words", "log_lines", "word_length", "upper", "digits", "symbols", "bangs", "punctuation", "blanks",
            "distinct_words", "adjacent_repeats", "repeat_windows", "dup_lines", "top_word", "ends_sentence")
SYMBOLS = np.frombuffer(b"#*$%&|<>@^_~=+\\{}[]", np.uint8)
PUNCTUATION = np.frombuffer(b".,;:?", np.uint8)


def doc_features(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    chars, letters = float(raw.sum()), float(raw[65:91].sum() + raw[97:123].sum() + raw[128:].sum()) or 1.0
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    distinct = len(set(words))
    windows = max(n - 2, 0)
    different = len(set(zip(words, words[1:], words[2:]))) if windows else 0
    repeats = sum(map(str.__eq__, words, words[1:]))
    return [math.log1p(n), math.log1p(len(lines)), sum(map(len, words)) / n, float(raw[65:91].sum()) / letters,
            float(raw[48:58].sum()) / chars, float(raw[SYMBOLS].sum()) / n, float(raw[33]) / n,
            float(raw[PUNCTUATION].sum()) / n, float(raw[32] + raw[9] + raw[10]) / n, distinct / n,
            repeats / n, 1 - different / windows if windows else 0.0, 1 - len(set(lines)) / len(lines),
            1.0 / distinct, float(words[-1][-1] in ".!?")]


@dataclass
class Model:
    cuts: list[np.ndarray]
    weights: np.ndarray
    prior: float

    @staticmethod
    def bin(cuts, x: np.ndarray) -> np.ndarray:
        """Column index of each feature's bin, then of its pair with word count."""
        at = np.stack([np.searchsorted(c, v, side="right") for c, v in zip(cuts, x.T)], 1)
        single = at + np.arange(len(cuts)) * (BINS + 1)
        size = at[:, :1] // 4
        pairs = at[:, 1:] + (BINS + 1) * (size * (len(cuts) - 1) + np.arange(len(cuts) - 1)) + len(cuts) * (BINS + 1)
        return np.concatenate([single, pairs], 1)

    @staticmethod
    def width(cuts) -> int:
        return (BINS + 1) * (len(cuts) + (BINS // 4 + 1) * (len(cuts) - 1)) + 1

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.weights[self.bin(self.cuts, x)].sum(1) + self.weights[-1]

    def predict(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        if not self.cuts:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-self.margin(np.array([doc_features(t) for t in texts]))))


def nn_pu(pos: np.ndarray, unl: np.ndarray, width: int, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights minimising the non-negative risk; rows are lists of bin columns."""
    w = np.zeros(width)
    w[-1] = math.log(prior / (1 - prior)) if 0 < prior < 1 else 0.0
    m, v = np.zeros(width), np.zeros(width)

    def gradient(rows, per_row):
        g = np.bincount(rows.ravel(), np.repeat(per_row, rows.shape[1]), width)
        g[-1] = per_row.sum()
        return g

    for t in range(1, steps + 1):
        # the sigmoid loss towards the negative class is s(z), towards the positive s(-z)
        sp, su = (1 / (1 + np.exp(-(w[rows].sum(1) + w[-1]))) for rows in (pos, unl))
        negative = su.mean() - prior * sp.mean()
        slope_p, slope_u = sp * (1 - sp) * prior / len(pos), su * (1 - su) / len(unl)
        g_negative = gradient(unl, slope_u) - gradient(pos, slope_p)
        g = gradient(pos, -slope_p) + g_negative if negative >= 0 else -DISCOUNT * g_negative
        g = g + RIDGE * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def separate(pos: np.ndarray, unl: np.ndarray, width: int, steps: int = 200) -> np.ndarray:
    """Logistic regression of positives against unlabelled, equal class weights."""
    rows = np.concatenate([pos, unl])
    y = np.r_[np.ones(len(pos)), np.zeros(len(unl))]
    share = np.where(y == 1, 0.5 / len(pos), 0.5 / len(unl))
    w, m, v = np.zeros(width), np.zeros(width), np.zeros(width)
    for t in range(1, steps + 1):
        d = (1 / (1 + np.exp(-(w[rows].sum(1) + w[-1]))) - y) * share
        g = np.bincount(rows.ravel(), np.repeat(d, rows.shape[1]), width) + 1e-3 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def best_bin_prior(zp: np.ndarray, zu: np.ndarray, confidence: float = 0.1) -> float:
    """Least upper bound of the share of positives among the unlabelled."""
    cuts = np.unique(np.quantile(zp, np.linspace(0, 0.95, 96)))
    above_p = (zp[:, None] >= cuts).mean(0)
    above_u = (zu[:, None] >= cuts).mean(0)
    margin = math.sqrt(math.log(4 / confidence) / 2)
    slack = margin / math.sqrt(len(zp)) + margin / math.sqrt(len(zu))
    best = int(np.argmin((above_u + slack) / above_p))
    return float(min(max(above_u[best] / above_p[best], 0.02), 0.98))


def fit_features(pos: np.ndarray, unl: np.ndarray) -> Model:
    """A model from feature rows of trusted positives and of unlabelled texts."""
    if not len(pos) or not len(unl):
        return Model([], np.zeros(0), 0.5 if not len(pos) else 1.0)
    both = np.concatenate([pos, unl])
    cuts = [np.unique(np.quantile(c, np.linspace(0.02, 0.98, BINS))) for c in both.T]
    p, u, width = Model.bin(cuts, pos), Model.bin(cuts, unl), Model.width(cuts)
    if min(len(p), len(u)) >= 40:
        w = separate(p[::2], u[::2], width)
        prior = best_bin_prior(w[p[1::2]].sum(1), w[u[1::2]].sum(1))
    else:
        prior = 0.5
    return Model(cuts, nn_pu(p, u, width, prior), prior)


def fit(documents: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
        max_unlabelled: int = MAX_UNLABELLED) -> Model:
    """Features are made on the executors; at most the two bounds of feature rows
    reach the driver: where a doc_id repeats, the row of least text hash is learnt from."""
    learn = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~in_holdout())
    known = learn.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    positives = known.where("quality = 1").orderBy(*order).limit(max_positives).select("doc_id", F.lit(1).alias("kind"))
    ids = documents.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & ~in_holdout())
    unlabelled = ids.join(known, "doc_id", "left_anti").distinct().orderBy(*order).limit(max_unlabelled) \
        .select("doc_id", F.lit(0).alias("kind"))

    def featurise(batches):
        for b in batches:
            x = [doc_features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(x, pa.list_(pa.float64()))],
                                             names=["doc_id", "kind", "x"])

    sample = F.broadcast(positives.union(unlabelled))  # bounded by the two limits
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(sample, "doc_id").groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"),
                                                      F.first("kind").alias("kind")).mapInArrow(featurise, "doc_id long, kind int, x array<double>").toPandas() \
        .sort_values(["kind", "doc_id"], kind="stable")
    by = [np.array(rows.loc[rows["kind"] == k, "x"].tolist()).reshape(-1, len(FEATURES)) for k in (1, 0)]
    return fit_features(*by)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score for every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(shared.value.predict(b.column(1).to_pylist()), pa.float64())],
                names=["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double") \
        .select("doc_id", F.coalesce(in_holdout(), F.lit(False)).alias("held_out"), "score")
