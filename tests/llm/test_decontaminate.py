import random

import duckdb
import numpy as np
import pytest

from gaffer.llm import decontaminate as dc

DOCS = "doc_id long, text string, n_words string, items int, spans int"


def brute(docs, bench):
    windows = {}
    for item, text in bench:
        w = dc.words_of(text)
        for k in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add("" if item is None else str(item))
    out = []
    for i, text in docs:
        w, hit, items = dc.words_of(text), set(), set()
        for m in {len(x) for x in windows}:
            for k in range(len(w) - m + 1):
                if tuple(w[k:k + m]) in windows:
                    hit.update(range(k, k + m))
                    items |= windows[tuple(w[k:k + m])]
        out.append((i, len(w), sorted(hit), sorted(items)))
    return sorted(out, key=str)


def rows_of(found):
    return sorted([(r.doc_id, r.n_words, [w for s in r.spans for w in range(s["first"], s["last"] + 1)], list(r["items"]))
                   for r in found.collect()], key=str)


def corpus(rnd, vocabulary):
    text = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    bench = [(k, text(rnd.randint(10, 30))) for k in range(12)] + [(20, text(3)), (21, text(1) + "zz"), (22, ""), (23, None),
                                                                    (None, text(12)), (24, text(9)), (24, text(40))]
    docs = []
    for i in range(60):
        t = text(rnd.randint(0, 60)).split()
        for _ in range(rnd.randint(0, 3)):
            w = (rnd.choice(bench)[1] or "").split()
            a = rnd.randint(0, max(len(w) - 5, 0))
            at = rnd.randint(0, len(t))
            t[at:at] = w[a:a + rnd.randint(1, 15)]
        docs.append((i, ", ".join(t).upper() if i % 3 else "\n".join(t)))
    return docs + [(90, None), (91, ""), (None, docs[1][1]), (5, docs[5][1]), (92, bench[0][1] + " x " + bench[0][1])], bench


@pytest.mark.parametrize("vocabulary", [3, 12, 200])
@pytest.mark.parametrize("block_bytes", [dc.BLOCK_BYTES, 400])
def test_equals_brute_force(llm, vocabulary, block_bytes):
    rnd = random.Random(vocabulary)
    docs, bench = corpus(rnd, [f"w{k}" for k in range(vocabulary)])
    found = dc.decontaminate(llm.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS),
                             llm.createDataFrame([(*b, 0) for b in bench], "item_id long, text string, doc_id int"), block_bytes)
    assert rows_of(found) == brute(docs, bench)


def test_words_fold_ascii_only():
    assert dc.words_of("Über-ÄRGER x_y [A1]\x7fZ\x00 q") == ["Über".encode(), "Ärger".encode().replace("ä".encode(), "Ä".encode()),
                                                                   b"x", b"y", b"a1", "z".encode(), " q".encode()]


def test_long_items_keep_every_window(llm, monkeypatch):
    words = [f"v{k}" for k in range(dc.CHUNK_WORDS * 2 + 500)]
    bench = llm.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = [(k, " ".join(words[a:a + 10])) for k, a in enumerate(range(dc.CHUNK_WORDS - 12, dc.CHUNK_WORDS + 3))]
    docs += [(100, " ".join(words)), (101, " ".join(words[::-1]))]
    found = dc.report(dc.decontaminate(llm.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS), bench)).collect()
    assert {r.doc_id: r.n_hit for r in found} == {**{k: 10 for k in range(15)}, 100: len(words), 101: 0}


def test_shifts_skip_and_pass_no_occurrence():
    rnd = np.random.default_rng(4)
    patterns = np.unique(rnd.integers(1, 50, (200, 10)), axis=0).astype(np.int32)
    s = dc.PatternSet(patterns, [["a"]] * len(patterns))
    ids = rnd.integers(0, 60, 5000).astype(np.int32)
    for k in range(0, 4900, 70):
        ids[k:k + 10] = patterns[rnd.integers(len(patterns))]
    starts, which = s.find(ids)
    want = [k for k in range(4991) if (ids[k:k + 10] == patterns).all(1).any()]
    assert sorted(starts.tolist()) == want
    assert all((ids[a:a + 10] == s.patterns[p]).all() for a, p in zip(starts, which))
    assert (s.shift > 1).mean() > 0.5


def test_empty_tables(llm):
    docs = llm.createDataFrame([(1, "a b", "x", 1, 2)], DOCS)
    bench = llm.createDataFrame([(1, "a b")], "item_id long, text string")
    assert dc.decontaminate(docs.limit(0), bench).count() == 0
    (row,) = dc.report(dc.decontaminate(docs, bench.limit(0))).collect()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (2, 0, 0, False)


def test_query_equals_sql(llm):
    docs, bench = corpus(random.Random(7), [f"w{k}" for k in range(9)])
    got = dc.report(dc.decontaminate(llm.createDataFrame([(*d, "x", 1, 2) for d in docs], DOCS),
                                     llm.createDataFrame(bench, "item_id long, text string"))).collect()
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.sql("create table benchmark (item_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", docs)
    con.executemany("insert into benchmark values (?, ?)", bench)
    want = con.sql(dc.ORACLE_SQL).fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
