"""Toxicity: gradient-boosted trees over dense features, isotonic calibration.

``fit(documents, labels)`` learns a model, ``score(documents, model)`` scores
every whole text. Features of a text (``doc_features``): densities of lexicon
words and of their weights, lexicon words near a second-person word, capitals,
exclamation and question marks, obfuscated words (digits or symbols standing
for letters) and obfuscated lexicon words, elongated words, length.

The lexicon is learnt: word beginnings of 4 to 8 characters and whole words,
each weighted by its log-odds between toxic and clean labelled texts. A labelled
text's own count is left out of the weights it meets (leave-one-out), so the
trees see features as they will be on new texts. Trees are histogram-based with
logistic loss; the calibration is a pool-adjacent-violators fit to
cross-validated tree scores.

Bounded: at most ``MAX_LABELLED`` labelled rows are learnt from, those least by a
hash of their id; the lexicon keeps ``MAX_LEXICON`` entries. Scoring has no bound.

Defined cases: a null text scores like an empty one; labels that are null teach
nothing; of several labels of one doc_id the largest counts; with no labels, or
of one class only, every score is that class's share (0 with none); a null doc_id
is scored and counts as not held out; rows that repeat are scored each; columns
other than doc_id and text are ignored.
"""
from __future__ import annotations

import math
import re
import uuid
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaffer.llm.common import in_holdout, stored, worker_cache

MAX_LABELLED = 20_000
REJECT_FROM = 0.7  # score from which a text counts as toxic
MAX_LEXICON = 20_000
MIN_TOXIC_TEXTS = 4
MIN_LOG_ODDS = 2.5
MAX_LOG_ODDS = 6.0
PREFIXES = (4, 5, 6, 7, 8)
NEAR = 5  # words
CACHE_WORDS = 250_000
# Second-person words of the four languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split())
LEET = str.maketrans("013457@$!|", "oieastasil")
NOT_WORD = re.compile(r"[\W_]+")
ELONGATED = re.compile(r"([^\W\d_])\1\1")
MIXED = re.compile(r"[^\W\d_][\d@$!|*]+[^\W\d_]")
FEATURES = ("weight_density", "lexicon_density", "strong_density", "max_weight", "log_hits", "near_you", "capitals",
            "bangs", "questions", "symbols", "obfuscated", "obfuscated_hits", "elongated", "log_words")


def keys_of(word: str) -> list[str]:
    return [word[:k] for k in PREFIXES if len(word) >= k] + [word + "$"]


def tokens_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def weight(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Log-odds weight of an entry; 0 where the evidence is too thin."""
    if toxic < MIN_TOXIC_TEXTS:
        return 0.0
    w = math.log((toxic + 0.5) / (n_toxic + 1.0)) - math.log((clean + 0.5) / (n_clean + 1.0))
    return min(w, MAX_LOG_ODDS) if w >= MIN_LOG_ODDS else 0.0


@dataclass
class Lexicon:
    counts: dict[str, tuple[int, int]]  # entry -> (toxic texts, clean texts)
    n_toxic: int
    n_clean: int
    name: str = field(default_factory=lambda: f"toxicity-{uuid.uuid4().hex}")  # of its cache

    def _weigh(self, word: str, own: int | None) -> float:
        """Largest weight of the word's entries; ``own`` is the label of the text
        that the word stands in, if that text was counted."""
        best = 0.0
        for k in keys_of(word):
            hit = self.counts.get(k)
            if hit:
                t, c = hit
                if own is None:
                    best = max(best, weight(t, c, self.n_toxic, self.n_clean))
                else:
                    best = max(best, weight(t - own, c - (1 - own), self.n_toxic - own, self.n_clean - (1 - own)))
        return best

    def look_up(self, token: str, own: int | None = None) -> tuple[float, bool, bool, bool]:
        """(weight, second person, obfuscated, elongated) of a raw token."""
        word = NOT_WORD.sub("", token)
        w = self._weigh(word, own) if word else 0.0
        hidden = bool(MIXED.search(token))
        if hidden and not w:
            plain = NOT_WORD.sub("", token.translate(LEET))
            w = self._weigh(plain, own)
            if not w and "*" in token:
                w = max(self._weigh(NOT_WORD.sub("", token.replace("*", v)), own) for v in "aeiou")
        return w, word in SECOND_PERSON, hidden, bool(ELONGATED.search(word))

    def notable(self, tokens: list[str], own: int | None) -> list[tuple[int, tuple]]:
        """Positions of the tokens that carry anything, with what they carry."""
        if own is not None:
            known = {t: self.look_up(t, own) for t in set(tokens)}
        else:
            known = worker_cache(self.name)
            if len(known) > CACHE_WORDS:
                known.clear()
            for t in set(tokens).difference(known):
                x = self.look_up(t)
                known[t] = x if any(x) else None
        if own is not None:
            known = {t: x if any(x) else None for t, x in known.items()}
        return [(k, x) for k, x in enumerate(map(known.__getitem__, tokens)) if x]


def doc_features(text: str | None, lexicon: Lexicon, own: int | None = None) -> list[float]:
    text = text or ""
    tokens = tokens_of(text)
    n = max(len(tokens), 1)
    found = lexicon.notable(tokens, own)
    hits = [(k, x[0]) for k, x in found if x[0]]
    you = [k for k, x in found if x[1]]
    near, j = 0, 0
    for k, _ in hits:
        while j < len(you) and you[j] < k - NEAR:
            j += 1
        near += j < len(you) and you[j] <= k + NEAR
    chars = max(len(text), 1)
    raw = np.frombuffer(text.encode(), np.uint8)
    seen = np.bincount(raw, minlength=256)
    total = sum(w for _, w in hits)
    return [total / n, len(hits) / n, sum(w >= 4 for _, w in hits) / n, max([0.0, *(w for _, w in hits)]),
            math.log1p(len(hits)), near / n, float(seen[65:91].sum()) / chars, float(seen[33]) / n, float(seen[63]) / n,
            float(seen[[35, 36, 37, 38, 42, 60, 62, 64, 124]].sum()) / n, sum(x[2] for _, x in found) / n,
            sum(bool(x[2] and x[0]) for _, x in found) / n, sum(x[3] for _, x in found) / n, math.log1p(len(tokens))]


# --- trees ---------------------------------------------------------------

BINS = 64


class BoostedTrees:
    """Histogram gradient boosting with logistic loss (second-order leaf values)."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.15, min_leaf: int = 8, ridge: float = 1.0):
        self.n_trees, self.depth, self.rate, self.min_leaf, self.ridge = trees, depth, rate, min_leaf, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.cuts = [np.unique(np.quantile(c[c != c.min()] if (c != c.min()).any() else c, np.linspace(0, 1, BINS - 1)))
                     for c in x.T]
        binned = self._bin(x)
        p = min(max(y.mean(), 1e-4), 1 - 1e-4)
        self.bias = math.log(p / (1 - p))
        score = np.full(len(y), self.bias)
        self.trees = []
        for _ in range(self.n_trees):
            prob = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, prob - y, prob * (1 - prob))
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T)], 1)

    def _grow(self, binned, grad, hess):
        """A full binary tree by level: arrays of feature, bin and leaf values."""
        features = np.zeros(2 ** self.depth - 1, np.int64)
        bins = np.full(2 ** self.depth - 1, BINS)
        node = np.zeros(len(grad), np.int64)
        for level in range(self.depth):
            first, width = 2 ** level - 1, 2 ** level
            local = node - first
            best = np.full(width, 1e-6)
            for f in range(binned.shape[1]):
                at = local * (BINS + 1) + binned[:, f]
                g, h, c = (np.bincount(at, v, width * (BINS + 1)).reshape(width, -1).cumsum(1)
                           for v in (grad, hess, np.ones(len(grad))))
                gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                gain = g ** 2 / (h + self.ridge) + (gt - g) ** 2 / (ht - h + self.ridge) - gt ** 2 / (ht + self.ridge)
                gain[(c < self.min_leaf) | (ct - c < self.min_leaf)] = 0
                top = gain.argmax(1)
                value = gain[np.arange(width), top]
                better = value > best
                best = np.where(better, value, best)
                features[first:first + width][better] = f
                bins[first:first + width][better] = top[better]
            right = binned[np.arange(len(node)), features[node]] > bins[node]
            node = 2 * node + 1 + right
        leaf = node - (2 ** self.depth - 1)
        g, h = (np.bincount(leaf, v, 2 ** self.depth) for v in (grad, hess))
        return (features, bins, -self.rate * g / (h + self.ridge)), leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._bin(x)
        rows = np.arange(len(x))
        out = np.full(len(x), self.bias)
        for features, bins, values in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[rows, features[node]] > bins[node])
            out += values[node - (2 ** self.depth - 1)]
        return out


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: knots (score, calibrated probability). Equal scores
    are one point, and every block is shrunk by one clean and one toxic half-count."""
    xs, at = np.unique(score, return_inverse=True)
    total, count = np.bincount(at, y), np.bincount(at)
    blocks: list[list[float]] = []
    for x, t, c in zip(xs, total, count):
        blocks.append([x, x, t, c])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            lo, hi = blocks[-2], blocks.pop()
            lo[1], lo[2], lo[3] = hi[1], lo[2] + hi[2], lo[3] + hi[3]
    knots = np.array([v for b in blocks for v in (b[0], b[1])])
    probs = np.array([(b[2] + 0.5 * y.mean()) / (b[3] + 0.5) for b in blocks for _ in (0, 1)])
    return knots, np.maximum.accumulate(probs)


@dataclass
class Model:
    lexicon: Lexicon
    trees: BoostedTrees | None
    knots: np.ndarray
    probs: np.ndarray
    constant: float

    def predict(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        if self.trees is None:
            return np.full(len(texts), self.constant)
        x = np.array([doc_features(t, self.lexicon) for t in texts])
        return np.clip(np.interp(self.trees.margin(x), self.knots, self.probs), 0.0, 1.0)


def fit_trees(x: np.ndarray, y: np.ndarray, folds: int = 4) -> tuple[BoostedTrees, np.ndarray, np.ndarray]:
    fold = np.arange(len(y)) % folds
    margins = np.zeros(len(y))
    for f in range(folds):
        if 0 < y[fold != f].sum() < (fold != f).sum():
            margins[fold == f] = BoostedTrees().fit(x[fold != f], y[fold != f]).margin(x[fold == f])
    return (BoostedTrees().fit(x, y), *isotonic(margins, y))


def training_labels(labels: DataFrame, column: str, limit: int = MAX_LABELLED) -> DataFrame:
    """At most ``limit`` rows (doc_id, label) that may be learnt from."""
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    return own.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & ~in_holdout()) \
        .groupBy("doc_id").agg(F.max("label").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """Learn from at most ``limit`` labelled rows, gathered by a broadcast of their
    ids (bounded by ``limit``); where a doc_id repeats, from the row of least text hash. Word counts are summed on the executors."""
    sample = training_labels(labels, "toxic", limit)
    texts = stored(documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                                    F.col("text").cast("string").alias("text"))
                   .join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
                       F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label")), "toxic-sample")

    def count(batches):
        counts: dict[str, list[int]] = {}
        for b in batches:
            for text, y in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = {NOT_WORD.sub("", t) for t in set(tokens_of(text))}
                for k in {k for w in words if w for k in keys_of(w)}:
                    counts.setdefault(k, [0, 0])[0 if y else 1] += 1
        names = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[k][0] for k in names], pa.int64()),
                                          pa.array([counts[k][1] for k in names], pa.int64())],
                                         names=["entry", "toxic", "clean"])

    n = {r["label"]: r["count"] for r in texts.groupBy((F.col("label") > 0).alias("label")).count().collect()}
    n_toxic, n_clean = n.get(True, 0), n.get(False, 0)
    if not n_toxic or not n_clean:
        return Model(Lexicon({}, n_toxic, n_clean), None, np.zeros(0), np.zeros(0), 1.0 if n_toxic else 0.0)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    entries = texts.mapInArrow(count, "entry string, toxic long, clean long").groupBy("entry") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")) \
        .where((F.col("toxic") >= MIN_TOXIC_TEXTS) & (odds >= MIN_LOG_ODDS)) \
        .orderBy(F.desc("toxic"), "entry").limit(MAX_LEXICON).collect()
    lexicon = Lexicon({r["entry"]: (r["toxic"], r["clean"]) for r in entries}, n_toxic, n_clean)
    shared = documents.sparkSession.sparkContext.broadcast(lexicon)

    def featurise(batches):
        for b in batches:
            ys = [int(y > 0) for y in b.column(2).to_pylist()]
            x = [doc_features(t, shared.value, y) for t, y in zip(b.column(1).to_pylist(), ys)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ys, pa.int32()), pa.array(x, pa.list_(pa.float64()))],
                                             names=["doc_id", "label", "x"])

    rows = texts.mapInArrow(featurise, "doc_id long, label int, x array<double>").toPandas() \
        .sort_values("doc_id", kind="stable")
    x, y = np.array(rows["x"].tolist()), rows["label"].to_numpy(float)
    return Model(lexicon, *fit_trees(x, y), float(y.mean()))


def score_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """The score of a text column, for use in any select or filter."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def predict(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.predict(texts.tolist()), dtype="float64")

    return predict(F.col(text).cast("string"))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score for every row."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .select("doc_id", F.coalesce(in_holdout(), F.lit(False)).alias("held_out"),
                score_column(documents.sparkSession, model).alias("score"))
