import random
import re

import pytest

from gaffer.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets_by_resharing(sizes, weights=(3, 1, 2), share=1.5):
    """The contract step by step: share, cut, reshare the excess until none is above."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        rest = total - sum(2 * sizes[s] for s in names if s not in free)
        level = rest / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not over:
            break
        free -= over
    return {s: level * w[s] if s in free else 2.0 * sizes[s] for s in names}


def check(rows, docs):
    sizes, taken = {}, {}
    assert len(rows) == len(docs)
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = targets_by_resharing(sizes) if any(sizes.values()) else {s: 0.0 for s in sizes}
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.5 + 1e-6


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 7), (3, 64)])
def test_takes_meet_the_targets(make_docs, seed, block):
    rnd = random.Random(seed)
    docs = [(i, " ".join("w" * rnd.randint(1, 300)) if rnd.random() < 0.9 else rnd.choice([None, "", " \t\n"]),
             rnd.choice(["a", "a", "a", "b", "é", "Z", None])) for i in range(300)]
    out = mixing.document_takes(make_docs(docs), block_words=block)
    rows = out.collect()
    check(rows, docs)
    assert sorted(rows, key=str) == sorted(mixing.document_takes(make_docs(docs), block_words=block).collect(), key=str)
    by = {d[0]: len(WORD.findall(d[1] or "")) for d in docs}
    assert all(by[r.doc_id] == r.size for r in rows)


def test_repeated_rows_blank_tables_and_null_ids(make_docs):
    docs = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", None), (2, None, "t"), (2, " ", "t")]
    check(mixing.document_takes(make_docs(docs)).collect(), docs)
    assert mixing.document_takes(make_docs(docs).limit(0)).count() == 0
    blank = [(1, "", "a"), (2, None, None)]
    check(mixing.document_takes(make_docs(blank)).collect(), blank)


def test_the_mix_is_a_schedule_of_equal_blocks(make_docs):
    rnd = random.Random(5)
    docs = [(i, "w " * rnd.randint(1, 200), rnd.choice("abc")) for i in range(400)]
    sizes, targets, streams, pieces = mixing.schedule_mix(make_docs(docs), block_words=32)
    words, source = {}, {}
    for r in pieces.collect():
        words[r.slot] = words.get(r.slot, 0) + r.to_word - r.from_word
        source[r.slot] = r.source_no
    assert sum(w != 32 for w in words.values()) <= 3  # each source's last block only
    # low discrepancy: every window of slots holds each source near its share
    order = [source[s] for s in sorted(source)]
    share = {s: order.count(s) / len(order) for s in set(order)}
    for lo in range(0, len(order) - 100, 50):
        for s in share:
            assert abs(order[lo:lo + 100].count(s) - 100 * share[s]) <= 6


def test_mixed_documents_repeat_whole_rows(make_docs):
    docs = [(i, "w " * 50, "big") for i in range(40)] + [(100 + i, "v " * 50, "small") for i in range(4)]
    df = make_docs(docs)
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    n = {}
    for r in out.collect():
        n[r.doc_id] = n.get(r.doc_id, 0) + 1
    takes = {r.doc_id: r.taken / r.size for r in mixing.document_takes(df).collect()}
    assert all(abs(n.get(i, 0) - t) <= 0.5 for i, t in takes.items()) and max(n.values()) <= 2


def test_no_python_on_the_main_path(make_docs):
    plan = mixing.document_takes(make_docs([(1, "a b", "s")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_rows_of_one_or_of_no_id_spread(make_docs):
    """Different texts of one doc_id, or of none, are not all in one bucket."""
    docs = [(None if k % 2 else 5, f"word{k} and more", "s") for k in range(400)]
    sizes = mixing.document_sizes(make_docs(docs))
    targets = mixing.source_targets(sizes)
    before = mixing.BUCKET_ROWS
    mixing.BUCKET_ROWS = 20
    try:
        sizes.count()
        rows = mixing._streams(sizes, targets, 7).collect()
        check(mixing.document_takes(make_docs(docs)).collect(), docs)
    finally:
        mixing.BUCKET_ROWS = before
    assert len(rows) == 400 and sorted(r.begin for r in rows) == [3 * k for k in range(400)]
    spread = sizes.select("spread").distinct().count()
    assert spread == 400


def broadcast_rows(node):
    """Rows of every table that an executed plan has broadcast."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return broadcast_rows(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return broadcast_rows(node.plan())
    own = [node.metrics().apply("numOutputRows").value()] if name == "BroadcastExchangeExec" else []
    return own + [n for k in range(node.children().size()) for n in broadcast_rows(node.children().apply(k))]


def test_slots_and_pieces_are_not_broadcast(make_docs):
    """Slots are as many as the mix has blocks, pieces more: the driver must hold neither."""
    docs = [(i, "w " * 200, "abc"[i % 3]) for i in range(600)]
    out = mixing.document_takes(make_docs(docs), block_words=1)
    check(out.collect(), docs)
    rows = broadcast_rows(out._jdf.queryExecution().executedPlan())
    assert rows and max(rows) <= 5000  # of 180,000 slots; the cells of the sources are the most
