import random
import zlib

import numpy as np
import pytest

from gaffer.llm import quality, toxicity
from gaffer.llm.queries import op2_positive_unlabelled, op4_boosted_trees

SF = "/root/testdata/sf0.1"


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.mark.parametrize("query,label,cut,least,wrong", [
    (op2_positive_unlabelled, "quality", 0.5, 0.95, 0.02), (op4_boosted_trees, "toxic", 0.7, 0.97, 0.01)])
def test_held_out_accuracy(llm, query, label, cut, least, wrong):
    rows = {r.doc_id: r for r in query(llm, SF).collect()}
    labels = {r.doc_id: r[label] for r in llm.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == llm.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= cut) for i, r in rows.items())
    test = [(labels[i], r.predicted) for i, r in rows.items() if r.held_out and i in labels]
    assert sum(y == p for y, p in test) / len(test) >= least
    # good or clean texts are left alone
    kind = 1 if label == "quality" else 0
    assert sum(y == kind and p != kind for y, p in test) / sum(y == kind for y, _ in test) <= wrong


def toy(make_docs, llm, n=600):
    rnd = random.Random(1)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(3, 7))) for _ in range(60)]
        bad = i % 5 == 0
        if bad:
            for k in rnd.sample(range(60), 4):
                words[k] = rnd.choice(["vexlo", "Vexlo!", "vexlomar", "quopp"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1 - int(bad), int(bad)))
    return make_docs(rows), llm.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows


def test_lexicon_is_learnt_with_stems_and_obfuscation(llm, make_docs):
    docs, labels, _ = toy(make_docs, llm)
    model = toxicity.fit(docs, labels)
    plain = "abcd efgh bcde " * 10
    scores = model.predict([plain, plain + "vexlo quopp vexlo", plain + "vexlotine quopped vexlo", plain + "v3xl0 qu0pp v3xlo", "", None])
    assert scores[0] < 0.3 < 0.7 <= min(scores[1:4]) and scores[4] == scores[5] < 0.7


@pytest.mark.parametrize("module", [quality, toxicity])
def test_edge_cases(llm, make_docs, module):
    docs, labels, rows = toy(make_docs, llm, 60)
    odd = make_docs([(1, None), (2, ""), (None, "x"), (3, "y " * 40_000), (4, "z"), (4, "z")])
    schema = "doc_id long, quality int, toxic int"
    for lab in (labels, labels.limit(0), llm.createDataFrame([(1, 1, 1), (2, None, None), (None, 0, 0), (1, 0, 0)], schema)):
        out = module.score(odd, module.fit(docs, lab)).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
        assert all(r.held_out == (r.doc_id is not None and held_out(r.doc_id)) for r in out)
        same = {r.score for r in out if r.doc_id in (1, 2)}
        assert len(same) == 1
    assert module.score(odd.limit(0), module.fit(docs.limit(0), labels)).count() == 0


def test_labels_of_held_out_rows_are_not_learnt(llm, make_docs):
    docs, labels, _ = toy(make_docs, llm, 300)
    from pyspark.sql import functions as F

    from gaffer.llm.common import in_holdout
    flipped = labels.withColumn("quality", F.when(in_holdout(), 1 - F.col("quality")).otherwise(F.col("quality"))) \
        .withColumn("toxic", F.when(in_holdout(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    for module in (quality, toxicity):
        a, b = (sorted(module.score(docs, module.fit(docs, x)).collect()) for x in (labels, flipped))
        assert a == b


def test_isotonic_is_monotone_and_calibrated():
    rnd = np.random.default_rng(1)
    s = rnd.normal(size=4000)
    y = (rnd.random(4000) < 1 / (1 + np.exp(-2 * s))).astype(float)
    knots, probs = toxicity.isotonic(s, y)
    assert (np.diff(knots) >= 0).all() and (np.diff(probs) >= 0).all()
    p = np.interp(s, knots, probs)
    for lo, hi in ((0, 0.2), (0.2, 0.5), (0.5, 0.8), (0.8, 1.01)):
        some = (p >= lo) & (p < hi)
        assert abs(p[some].mean() - y[some].mean()) < 0.05


def test_trees_fit_an_interaction():
    rnd = np.random.default_rng(2)
    x = rnd.random((3000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    m = toxicity.BoostedTrees().fit(x[:2000], y[:2000]).margin(x[2000:])
    assert ((m > 0) == y[2000:]).mean() > 0.95


def test_prior_and_non_negative_risk_on_known_mixtures():
    """Unlabelled = 70 % positives: the estimate is near, and the model separates."""
    rnd = np.random.default_rng(3)
    cloud = lambda n, good: rnd.normal(size=(n, len(quality.FEATURES))) + (0.0 if good else 2.0)
    unl = np.concatenate([cloud(2100, True), cloud(900, False)])
    model = quality.fit_features(cloud(2000, True), unl)
    assert 0.62 <= model.prior <= 0.82
    good, bad = model.margin(cloud(500, True)), model.margin(cloud(500, False))
    assert (good > 0).mean() > 0.95 and (bad < 0).mean() > 0.9


def test_a_repeated_id_is_learnt_from_once(llm, make_docs):
    """Rows that repeat a labelled id neither reach the driver nor outweigh the rest."""
    docs, labels, _ = toy(make_docs, llm, 300)
    from pyspark.sql import functions as F
    some = docs.where("doc_id = 3")
    many = docs.unionByName(some.crossJoin(llm.range(400).select()))
    assert many.count() == docs.count() + 400
    for module in (quality, toxicity):
        a, b = module.fit(docs, labels), module.fit(many, labels)
        texts = [r.text for r in docs.orderBy("doc_id").limit(40).collect()]
        assert np.allclose(a.predict(texts), b.predict(texts), atol=1e-12), module.__name__


def test_first_split_equals_a_naive_search():
    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 12, (120, 3)).astype(float)
    y = (x[:, 1] + rnd.normal(size=120) * 3 > 6).astype(float)
    trees = toxicity.BoostedTrees(trees=1, depth=1)
    trees.fit(x, y)
    (features, bins, values), = trees.trees
    binned = trees._bin(x)
    grad, hess = np.full(120, y.mean()) - y, np.full(120, y.mean() * (1 - y.mean()))

    def gain(left):
        part = lambda m: grad[m].sum() ** 2 / (hess[m].sum() + trees.ridge)
        return part(left) + part(~left) - part(np.ones(120, bool))
    best = max(((gain(binned[:, f] <= b), -f, -b) for f in range(3) for b in range(12)
                if min((binned[:, f] <= b).sum(), (binned[:, f] > b).sum()) >= trees.min_leaf))
    assert (features[0], bins[0]) == (-best[1], -best[2])
    left = binned[:, features[0]] <= bins[0]
    for leaf, m in enumerate((left, ~left)):
        assert np.isclose(values[leaf], -trees.rate * grad[m].sum() / (hess[m].sum() + trees.ridge))


def test_isotonic_blocks_equal_the_min_max_formula():
    rnd = np.random.default_rng(6)
    for _ in range(20):
        s = rnd.integers(0, 15, 60).astype(float)
        y = (rnd.random(60) < s / 15).astype(float)
        xs = np.unique(s)
        mean = lambda a, b: y[(s >= xs[a]) & (s <= xs[b])].mean()
        level = [max(min(mean(a, b) for b in range(i, len(xs))) for a in range(i + 1)) for i in range(len(xs))]
        knots, probs = toxicity.isotonic(s, y)
        for x, v in zip(xs, level):
            block = np.isin(s, xs[np.isclose(level, v)])
            want = (y[block].sum() + 0.5 * y.mean()) / (block.sum() + 0.5)
            assert np.isclose(np.interp(x, knots, probs), want, atol=0.02)


def test_weights_are_near_the_least_non_negative_risk():
    rnd = np.random.default_rng(7)
    bins = lambda n, p: np.stack([(rnd.random(n) < p).astype(int), 2 + (rnd.random(n) < 0.5).astype(int)], 1)
    pos, unl, prior = bins(400, 0.9), np.concatenate([bins(500, 0.9), bins(300, 0.1)]), 0.6
    w = quality.nn_pu(pos, unl, 5, prior)

    def risk(w):
        s = lambda z: 1 / (1 + np.exp(-z))
        zp, zu = (w[r].sum(1) + w[-1] for r in (pos, unl))
        return prior * s(-zp).mean() + max(0.0, s(zu).mean() - prior * s(zp).mean()) + quality.RIDGE / 2 * (w * w).sum()
    assert all(risk(w) <= risk(w + rnd.normal(size=5) * 0.5) + 0.01 for _ in range(200))
    assert risk(w) < risk(np.zeros(5)) - 0.05
