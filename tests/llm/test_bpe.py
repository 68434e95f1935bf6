import hashlib
import random

import numpy as np
import pytest

from gaffer.llm import bpe
from gaffer.llm.queries import op5_segment_tree_bpe, tokenizer_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def own():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return bpe.ByteBpe(f.read())


def expected(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


ALPHABET = ["a", "b", " ", "  ", "\n", "\t", "é", "1", "'s", "'", "<|endoftext|>", ".", "，", " ", "😀", "th",
            "\r\n", "　", "\x1c", "The", "ing", "0", "$$$"]


def test_random_texts_equal_the_library(library, own):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 16))) for _ in range(4000)]
    for t, ids in zip(texts, own.encode_batch(texts)):
        assert ids == expected(library, t), repr(t)
        assert own.decode(ids) == library.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)


def test_runs_of_every_length_and_a_very_long_one(library, own):
    for n in range(1, 140):
        assert own.encode("a" * n) == expected(library, "a" * n)
    long = "the quick" * 3000 + "b" * 50_000
    assert own.encode(long) == expected(library, long)


def test_the_batched_tree_equals_the_single_one(own):
    rnd = random.Random(2)
    for width in bpe.TREE_WIDTHS:
        words = [bytes(rnd.choice(b"theinganda 01") for _ in range(rnd.randint(1, width))) for _ in range(200)]
        for w, got in zip(words, own.merge_many(words, width)):
            ids = bpe.merge_segment_tree([own.byte_ids[b] for b in w], own.ranks)
            assert got == np.array(ids, "<u4").tobytes()


def test_leftmost_lowest_rank_by_scan(own):
    """The definition: while a pair can merge, merge the leftmost of lowest rank."""
    rnd = random.Random(3)
    for _ in range(200):
        ids = [own.byte_ids[rnd.choice(b"etaoin ")] for _ in range(rnd.randint(1, 30))]
        slow = list(ids)
        while True:
            pairs = [(own.ranks[p][0], k) for k, p in enumerate(zip(slow, slow[1:])) if p in own.ranks]
            if not pairs:
                break
            k = min(pairs)[1]
            slow[k:k + 2] = [own.ranks[slow[k], slow[k + 1]][1]]
        assert bpe.merge_segment_tree(ids, own.ranks) == slow


def test_operator_edge_cases(make_docs, library):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "x" * 30_000), (5, "Twice"), (5, "Twice"), (None, "no id")]
    out = bpe.encode_decode(make_docs(rows), tokenizer_path()).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids), r.decoded) for r in out) == sorted(
        (i is None, i or 0, expected(library, t), t or "") for i, t in rows)
    assert bpe.encode_decode(make_docs(rows).limit(0), tokenizer_path()).count() == 0


def test_query_digests(llm, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_segment_tree_bpe(llm, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = expected(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
