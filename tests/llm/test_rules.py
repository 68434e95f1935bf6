import random
import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from gaffer.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = Counter(zip(words, words[1:], words[2:]))
    covered = {k for i in range(len(words) - 2) if count[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def random_text(rnd):
    return "".join(rnd.choice(["a", "b", "c", " ", " ", "\n", "\t", "é", "😀", "#", "|", "a b c ", "\x0b", " ", "!"])
                   for _ in range(rnd.randint(0, 120)))


def test_base_counts(make_docs):
    rnd = random.Random(4)
    docs = [(i, random_text(rnd)) for i in range(400)] + [
        (1000, None), (1001, ""), (1002, " \n \t"), (1003, "x y z " * 5000), (1004, "a a a a"), (1005, "b\nb\n\nb"),
        (1006, "p q"), (1007, "\n"), (1008, "a b c"), (None, "n n n n")]
    got = {r.doc_id: r for r in rules.rule_signals(make_docs(docs)).collect()}
    for i, t in docs:
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base(t), (i, t)


def tail(k, n, p):
    return sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))


def test_binomial_tail_is_exact(llm):
    cases = [(k, n, p) for n in (0, 1, 7, 60, 400) for k in (0, 1, 2, 5) for p in (0.004, 0.05, 0.3) if k <= n]
    for k, n, p in cases:
        got = llm.range(1).select(rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("v")).first().v
        assert got == pytest.approx(1.0 if k >= n * p else tail(k, n, p), rel=1e-9)
    big = llm.range(1).select(rules.binomial_tail(F.lit(90).cast("long"), F.lit(1_000_000).cast("long"), 0.01).alias("v"))
    assert 0 <= big.first().v < 1e-300


def judged(llm, make_docs, rows, labels, **kw):
    lab = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return {r.doc_id: r for r in rules.judge(make_docs(rows), lab, **kw).collect()}


def test_certified_cutoffs_by_brute_force(llm, make_docs):
    rnd = random.Random(6)
    prose = lambda: " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(3, 7))) for _ in range(80))
    rows, labels = [], []
    for i in range(900):
        junk = i % 6 == 0
        text = prose()
        text = " ".join(w + ("###" if junk else "") for w in text.split())
        rows.append((i, text, "s", "en"))
        labels.append((i, 0 if junk else 1, 0))
    rows += [(5000 + i, prose(), "s", "few") for i in range(5)] + [(6000, "a## " * 80, "s", "few")]
    labels += [(5000 + i, 1, 0) for i in range(5)]
    got = judged(llm, make_docs, rows, labels, total_risk=0.1, delta=0.1)
    for i in range(900):
        assert got[i].kept == (i % 6 != 0)
    assert not got[6000].base_failed or got[6000].n_repeat_words  # judged by the base rule alone:
    assert all(not got[5000 + i].broken for i in range(5))  # too few labels certify nothing
    # the rule's own chain, step by step
    signals = rules.rule_signals(make_docs(rows))
    lab = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    cut = {(r.stratum, r.rule): r for r in rules.certified_cutoffs(signals, lab, 0.1, 0.1).collect()}
    held = [r for r in signals.collect() if r.stratum == "en" and r.doc_id % 6 and r.n_words >= 50
            and 2 * r.n_repeat_words <= r.n_words]
    risk, level = 0.1 / len(rules.CUTOFFS), 0.1 / (2 * len(rules.CUTOFFS))
    for rule, chain in rules.CUTOFFS.items():
        best = None
        for c in chain:
            lost = sum((r[rule] < c) if rule.startswith("low_") else (r[rule] > c) for r in held)
            if lost >= len(held) * risk or tail(lost, len(held), risk) > level:
                break
            best = c
        assert (cut[("en", rule)].cutoff if ("en", rule) in cut else None) == best
    assert not any(s == "few" for s, _ in cut)


def test_edge_cases(llm, make_docs):
    rows = [(1, None, "s", None), (2, "", "s", "en"), (3, "w " * 60, "s", None), (4, "w x " * 40), (4, "q"), (None, "z")]
    labels = [(1, None, 0), (2, 1, 0), (4, 1, 0), (4, 0, 0), (77, 1, 1), (None, 1, 0)]
    lab = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = rules.judge(make_docs(rows), lab)
    assert out.count() == len(rows) and out.where("base_failed and kept").count() == 0
    assert rules.judge(make_docs(rows).limit(0), lab.limit(0)).count() == 0
    assert rules.judge(make_docs(rows), lab.limit(0)).where("size(broken) > 0").count() == 0


def test_no_python_on_the_main_path(llm, make_docs):
    lab = llm.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    signals = rules.rule_signals(make_docs([(1, "a b c d")]))
    for df in (signals, rules.certified_cutoffs(signals, lab), rules.judge(make_docs([(1, "a b c")]), lab)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
