import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gaffer.llm import jaccard as J


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(*(words[k:] for k in range(5)))) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows, percent=80):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = {i: i for i, _ in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for (i, x), (j, y) in itertools.combinations([s for s in sets if s[0] is not None], 2):
        both = len(x & y)
        if x and y and 100 * both >= percent * (len(x) + len(y) - both):
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return sorted(((i is None, i or 0, len(x), None if i is None else find(i)) for i, x in sets), key=str)


def run(make_docs, rows, percent=80):
    out, _ = J.similar_documents(make_docs(rows), percent)
    return sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in out.collect()), key=str)


def corpus(seed, groups=25, noise=120, long=False):
    """Groups of near copies with zero to many edits, shared passages, short texts."""
    rnd = random.Random(seed)
    word = lambda: "w%d" % rnd.randrange(4000)
    texts = [" ".join(word() for _ in range(rnd.choice([1, 2, 4, 5, 6, 9, 40, 120, 300]))) for _ in range(noise)]
    shared = [word() for _ in range(30)]
    for _ in range(groups):
        base = [word() for _ in range(rnd.choice([5, 7, 8, 12, 30, 90, 146, 400 if long else 60]))]
        for _ in range(rnd.choice([2, 3, 8, 25])):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, 5])):
                t[rnd.randrange(len(t))] = word()
            if rnd.random() < 0.2:
                t = t + shared
            texts.append(" ".join(t))
    rnd.shuffle(texts)
    return [(i, t if rnd.random() < 0.5 else t.upper()) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(make_docs, seed):
    rows = corpus(seed, long=True)
    assert run(make_docs, rows) == brute(rows)


def test_hard_allocation_equals_brute_force(make_docs, monkeypatch):
    """Deletion neighbourhoods for nearly every set, one leader per key, tiny blocks."""
    monkeypatch.setattr(J, "COSTLY", 0.1)
    monkeypatch.setattr(J, "LEADERS", 1)
    monkeypatch.setattr(J, "BLOCK_KEYS", 500)
    monkeypatch.setattr(J, "CROWDED", 3)
    monkeypatch.setattr(J, "BROADCAST_ROWS", 0)
    rows = corpus(3, groups=15, noise=40)
    assert run(make_docs, rows) == brute(rows)


def test_edge_cases(make_docs):
    rows = [(9, None), (8, ""), (7, " \t\n\x0b"), (6, "one two"), (5, "ONE\ttwo"), (4, "one two three"), (3, "é a b c d e"),
            (2, "É a b c d e"), (1, "x " * 6000), (0, "x " * 20), (11, "same id"), (11, "same id"), (11, "other text"),
            (12, "other text"), (None, "same id"), (None, None)]
    assert run(make_docs, rows) == brute(rows)
    out, links = J.similar_documents(make_docs(rows).limit(0))
    assert out.count() == 0 and links.count() == 0


def test_other_thresholds(make_docs):
    rows = corpus(4, groups=10, noise=20)
    for percent in (50, 95):
        assert run(make_docs, rows, percent) == brute(rows, percent)


def test_pigeonhole_of_bands():
    """Any two similar sizes share a band, and each side's need covers their difference."""
    for r in [*range(1, 400), 1000, 4321]:
        for s in range(r, r * 100 // 80 + 1):
            h = J.difference_bound(r, s)
            low, up = {b: n for b, u, n in J.roles(r) if not u}, {b: n for b, _, n in J.roles(s)}
            shared = set(low) & set(up)
            assert shared
            for b in shared:
                assert low[b] > h and up[b] > h and len(J.segment_bounds(80, b)) >= max(low[b], up[b])


def test_segments_and_deletions_agree():
    rnd = np.random.default_rng(1)
    h = np.unique(rnd.integers(0, 1 << 63, 60).astype(np.uint64) * np.uint64(2))
    band = J.roles(len(h))[0][0]
    keys, at = J.segments(h, 80, band)
    seg, less = J.deletion_keys(h, at, band)
    for k in range(len(h)):
        without = np.delete(h, k)
        assert J.segments(without, 80, band)[0][seg[k]] == less[k]


def test_parity_sketch_is_a_lower_bound():
    rnd = random.Random(2)
    for _ in range(200):
        x = np.array(sorted(rnd.sample(range(1 << 40), 50)), np.uint64)
        y = np.unique(np.concatenate([x[rnd.randrange(20):], np.array([rnd.randrange(1 << 40) for _ in range(9)], np.uint64)]))
        a, b = (J.parity_sketch(v, 80, 12).view(np.uint64) for v in (x, y))
        bits = sum(int(v).bit_count() for v in a ^ b)
        assert bits <= len(set(x.tolist()) ^ set(y.tolist()))


def test_cheapest_allocation_reaches_the_need():
    rnd = random.Random(3)
    for _ in range(300):
        m = rnd.randint(1, 12)
        plain = {s: rnd.randrange(30) for s in range(m)}
        loose = {s: plain[s] + rnd.randrange(20) for s in range(m)}
        need = rnd.randint(0, m)
        taken = J.cheapest_allocation(need, plain, loose)
        assert sum(a + 1 for a in taken.values()) >= need and set(taken.values()) <= {0, 1}
        cost = sum(loose[s] if a else plain[s] for s, a in taken.items())
        assert cost <= sum(sorted(plain.values())[:need])


def test_one_of_each_keeps_the_smallest(make_docs):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (4, ""), (5, "q r s t u v"), (5, "q r s t u v"), (None, "a b c d e f g")]
    out = J.one_of_each(make_docs(rows))
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "2", "4", "5", "None"]


def test_components_helper(llm):
    from gaffer.llm.common import components
    edges = [(1, 2), (2, 3), (9, 3), (10, 11), (11, 12), (12, 10), (7, 7)] + [(100 + i, 101 + i) for i in range(40)]
    df = llm.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got[9] == 1 and got[12] == 10 and got[140] == 100 and len(got) == 4 + 3 + 41
    assert components(df.limit(0)).count() == 0
    assert components(df.where(F.col("a") == F.col("b"))).count() == 0


def repeated_parts(llm, make_docs, tmp_path, *parts):
    """A documents table with one file, and one partition, for each part."""
    for rows in parts:
        make_docs(rows).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    df = llm.read.parquet(str(tmp_path / "docs"))
    assert df.rdd.getNumPartitions() == len(parts)
    return df


def test_equal_blocks_in_two_files(llm, make_docs, tmp_path):
    """A part file that occurs twice, and one with other texts of the same sizes."""
    part = [(1, "a b c d e f g"), (2, "q r s t u v w"), (3, None)]
    other = [(1, "h i j k l m n"), (2, "q r s t u v w"), (3, None)]
    last = [(4, "h i j k l m n"), (5, "a b c d e f g")]
    df = repeated_parts(llm, make_docs, tmp_path, part, part, other, last)
    out, _ = J.similar_documents(df)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in out.collect()), key=str)
    assert got == brute([*part, *part, *other, *last])
    left = J.one_of_each(df).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, left))) == sorted(map(str, {*part, *other}))


def test_a_long_text_of_the_same_id_hides_no_link(make_docs):
    rnd = random.Random(5)
    words = lambda n: ["v%d" % rnd.randrange(10 ** 9) for _ in range(n)]
    long, other, short = words(4000), words(4000), words(32)  # 28 shingles: in one band only
    other[100:1700] = long[100:1700]  # some segments in common
    rows = [(1, " ".join(long)), (1, " ".join(short)), (2, " ".join([*short[:-1], "x"])), (3, " ".join(other)),
            (4, " ".join([*other[:-1], "x"])), (1, " ".join(short))]
    assert run(make_docs, rows) == brute(rows)
