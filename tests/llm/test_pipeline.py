"""The stages against the brute-force versions of their operators, on one small table."""
import re

import pytest

import corpus_pipeline
from gaffer.llm import pipeline, toxicity
from gaffer.llm.common import load, stored
from tests.llm.test_jaccard import brute as similar
from tests.llm.test_linededup import brute as lines_left
from tests.llm.test_mixing import targets_by_resharing

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def tables(llm):
    docs, out = load(llm, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(llm, docs, SF), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def rows_of(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_and_columns(tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mix_sources", "bpe"]
    for name, (before, after) in tables.items():
        assert name == "bpe" or tuple(after.columns) == pipeline.COLUMNS


def test_toxic_documents_go_and_others_stay_whole(llm, tables):
    before, after = tables["toxicity"]
    model = toxicity.fit(before, load(llm, SF, "labels"))
    given = before.collect()
    keep = {r.doc_id for r, s in zip(given, model.predict([r.text for r in given])) if s < toxicity.REJECT_FROM}
    assert rows_of(after) == {i: r for i, r in rows_of(before).items() if i in keep}


def test_repeated_lines_go(tables):
    before, after = tables["line_dedup"]
    given, got = rows_of(before), rows_of(after)
    for i, (n, lost, text) in lines_left([(i, r.text) for i, r in given.items()]).items():
        if lost and lost == n:
            assert i not in got
        else:
            assert got[i].text == text and (lost == 0 or got[i].n_chars == len(text))


def test_one_of_each_group_stays(tables):
    before, after = tables["near_duplicates"]
    want = {i for _, i, _, c in similar([(r.doc_id, r.text) for r in before.collect()]) if i == c}
    assert rows_of(after) == {i: r for i, r in rows_of(before).items() if i in want}


def test_sources_meet_their_targets(tables):
    before, after = tables["mix_sources"]
    size, words, largest = {}, {}, {}
    for r in before.collect():
        n = len(WORD.findall(r.text or ""))
        size[r.source] = size.get(r.source, 0) + n
        largest[r.source] = max(largest.get(r.source, 0), n)
    for r in after.collect():
        words[r.source] = words.get(r.source, 0) + len(WORD.findall(r.text or ""))
    for s, target in targets_by_resharing(size).items():
        assert abs(words.get(s, 0) - target) <= largest[s] / 2 + 1


def test_tokens_of_the_mix(tables):
    before, after = tables["bpe"]
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(pipeline.tokenizer_path())
    want = sorted((r.doc_id, len(t.encode(r.text or "", add_special_tokens=False).ids)) for r in before.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in after.collect()) == want


def test_run_returns_the_last_stage(llm, tables):
    out = corpus_pipeline.run(llm, SF)
    assert sorted((r.doc_id, r.n_tokens) for r in out.collect()) == sorted(
        (r.doc_id, r.n_tokens) for r in tables["bpe"][1].collect())


def test_empty_tables(llm):
    empty = load(llm, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(llm, empty, SF)
        assert empty.count() == 0
