"""Byte-level BPE encoding and decoding by a segment tree over adjacent pair ranks.

``encode_decode(df, tokenizer_json)`` takes a table with ``doc_id`` and
``text`` and returns one row per input row: ``doc_id``, ``ids`` (binary: the
token ids as little-endian unsigned 32-bit integers, no special tokens added)
and ``decoded`` (the text that decoding those ids gives).

Each pre-token is merged on its own: the leaves of a segment tree hold
``(merge rank, position)`` of every adjacent pair, the root is the leftmost
pair of lowest rank, and a merge changes three leaves, each updated in
logarithmic time, until the root holds no mergeable pair. A pre-token of n
bytes costs O(n log n), also when a text is one unbroken run.

Defined cases: a null text is encoded like an empty one (no ids, decoded
text ""); null ids and repeated rows are kept as they are; columns other than
``doc_id`` and ``text`` are ignored. A special token's string inside a text
becomes that token's id, as the tokenizers library does.
"""
from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import worker_cache

# Fixed value: the byte-level pre-token pattern of the vocabulary.
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# A space is a certain pre-token border unless it stands inside a run of blanks
# and is followed by one (or by the end).
UNSAFE_SPACE = re.compile(r"\s (?:\s|$)")
CACHE_ENTRIES = 700_000
TREE_WIDTHS = (4, 8, 16, 32, 64)  # longer pre-tokens take the tree one by one
TREE_ROWS = 4096
NO_PAIR = 1 << 62
POSITION_BITS = 32


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def merge_segment_tree(ids: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge one pre-token. ``ranks`` maps a pair of ids to (rank, merged id)."""
    n = len(ids)
    if n < 2:
        return ids
    width = 1
    while width < n - 1:
        width *= 2
    tree = [NO_PAIR] * (2 * width)
    for i in range(n - 1):
        hit = ranks.get((ids[i], ids[i + 1]))
        if hit is not None:
            tree[width + i] = hit[0] << POSITION_BITS | i
    for k in range(width - 1, 0, -1):
        left, right = tree[2 * k], tree[2 * k + 1]
        tree[k] = left if left < right else right

    def put(leaf: int, value: int) -> None:
        k = width + leaf
        if tree[k] == value:
            return
        tree[k] = value
        k >>= 1
        while k:
            left, right = tree[2 * k], tree[2 * k + 1]
            low = left if left < right else right
            if tree[k] == low:
                break
            tree[k] = low
            k >>= 1

    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    ids = list(ids)
    while tree[1] < NO_PAIR:
        i = tree[1] & ((1 << POSITION_BITS) - 1)
        j = after[i]
        ids[i] = ranks[ids[i], ids[j]][1]
        ids[j] = -1
        k = after[i] = after[j]
        if j < n - 1:
            put(j, NO_PAIR)
        if k < n:
            before[k] = i
            hit = ranks.get((ids[i], ids[k]))
            put(i, NO_PAIR if hit is None else hit[0] << POSITION_BITS | i)
        else:
            put(i, NO_PAIR)
        p = before[i]
        if p >= 0:
            hit = ranks.get((ids[p], ids[i]))
            put(p, NO_PAIR if hit is None else hit[0] << POSITION_BITS | p)
    return [x for x in ids if x >= 0]


class ByteBpe:
    """Encoder and decoder for one tokenizers-JSON byte-level vocabulary."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        pre = j["pre_tokenizer"]
        if j["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("only plain byte-level BPE vocabularies are supported")
        alphabet = byte_alphabet()
        vocab = j["model"]["vocab"]
        self.pieces: dict[int, bytes] = {i: bytes(alphabet[c] for c in t) for t, i in vocab.items()}
        self.byte_ids = {b: vocab[c] for c, b in alphabet.items()}
        self.ranks = {}
        for rank, pair in enumerate(j["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a], vocab[b]] = rank, vocab[a + b]
        self.added = {t["content"]: t["id"] for t in j["added_tokens"]}
        for t, i in self.added.items():
            self.pieces[i] = t.encode()
        self.added_at = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") \
            if self.added else None
        self.byte_table = np.array([self.byte_ids[b] for b in range(256)], np.int64)
        self._rank_keys()
        self.use_cache({})

    def use_cache(self, cache: dict[str, bytes]) -> None:
        """Ids of pieces of text; the added tokens are always among them."""
        self.cache = cache
        cache |= {t: np.array([i], "<u4").tobytes() for t, i in self.added.items()}

    def _rank_keys(self) -> None:
        items = sorted((a << 32 | b, rank) for (a, b), (rank, _) in self.ranks.items())
        self.pair_keys = np.array([k for k, _ in items], np.int64)
        self.pair_ranks = np.array([r for _, r in items], np.int64)
        self.merged = np.zeros(len(items), np.int64)
        for rank, new in self.ranks.values():
            self.merged[rank] = new

    def _pair_leaf(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values (rank, position) of pairs of ids; ids below 0 make no pair."""
        key = left << 32 | right
        k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        found = (self.pair_keys[k] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[k] << POSITION_BITS | at, NO_PAIR)

    def merge_many(self, words: list[bytes], width: int) -> list[bytes]:
        """The same segment tree for many pre-tokens of at most ``width`` bytes
        at once: one tree per row, each step merges every row's root pair."""
        n = len(words)
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(n, width)
        sizes = np.fromiter(map(len, words), np.int64, n)
        columns = np.arange(width)
        inside = columns < sizes[:, None]
        ids = np.full((n, width + 1), -1, np.int64)
        ids[:, :width] = np.where(inside, self.byte_table[raw], -1)
        tree = np.full((n, 2 * width), NO_PAIR, np.int64)
        tree[:, width:] = self._pair_leaf(ids[:, :-1], ids[:, 1:], columns)
        k = width
        while k > 1:
            tree[:, k // 2:k] = np.minimum(tree[:, k:2 * k:2], tree[:, k + 1:2 * k:2])
            k //= 2
        # one spare column at the end stands for "none"; -1 wraps to it
        after = np.tile(np.append(columns + 1, width), (n, 1))
        before = np.tile(np.append(columns - 1, -1), (n, 1))
        row = np.flatnonzero(tree[:, 1] < NO_PAIR)
        while len(row):
            root = tree[row, 1]
            i = root & ((1 << POSITION_BITS) - 1)
            new = self.merged[root >> POSITION_BITS]
            j = after[row, i]
            k = after[row, j]
            ids[row, i], ids[row, j] = new, -1
            after[row, i], before[row, k] = k, i
            p = before[row, i]
            leaf_p = np.where(p >= 0, p, i)
            tree[row, width + j] = NO_PAIR
            tree[row, width + leaf_p] = self._pair_leaf(np.where(p >= 0, ids[row, p], -1), new, p)
            tree[row, width + i] = self._pair_leaf(new, ids[row, k], i)
            nodes = [width + j, width + i, width + leaf_p]
            for _ in range(width.bit_length() - 1):
                nodes = [x >> 1 for x in nodes]
                for x in nodes:
                    tree[row, x] = np.minimum(tree[row, 2 * x], tree[row, 2 * x + 1])
            row = row[tree[row, 1] < NO_PAIR]
        kept = ids[:, :width] >= 0
        flat = ids[:, :width][kept].astype("<u4").tobytes()
        ends = np.cumsum(kept.sum(1)).tolist()
        out, at = [], 0
        for e in ends:
            out.append(flat[4 * at:4 * e])
            at = e
        return out

    def merge_all(self, tokens: list[str]) -> dict[str, bytes]:
        """Ids of each pre-token, as little-endian 32-bit bytes."""
        out: dict[str, bytes] = {}
        classes: dict[int, tuple[list[str], list[bytes]]] = {}
        for t in tokens:
            w = t.encode()
            width = next((c for c in TREE_WIDTHS if len(w) <= c), 0)
            if width:
                names, words = classes.setdefault(width, ([], []))
                names.append(t)
                words.append(w)
            else:
                ids = merge_segment_tree([self.byte_ids[b] for b in w], self.ranks)
                out[t] = np.array(ids, "<u4").tobytes()
        for width, (names, words) in classes.items():
            for k in range(0, len(words), TREE_ROWS):
                out.update(zip(names[k:k + TREE_ROWS], self.merge_many(words[k:k + TREE_ROWS], width)))
        return out

    def _chunks(self, text: str) -> list[str]:
        """Pieces that start and end on a pre-token border: whole words where
        every space is a border, else the pre-tokens themselves."""
        if UNSAFE_SPACE.search(text):
            return PRETOKEN.findall(text)
        first, *rest = text.split(" ")
        chunks = [" " + x for x in rest]
        return [first, *chunks] if first else chunks

    def encode_batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text. The batch's new pieces are merged together; a
        cache of bounded size keeps the pieces met before."""
        cut = [[] if not t else self.added_at.split(t) if self.added_at and self.added_at.search(t) else [t]
               for t in texts]
        parts = [[c for piece in pieces for c in ([piece] if piece in self.added else self._chunks(piece) if piece
                                                  else [])] for pieces in cut]
        if len(self.cache) > CACHE_ENTRIES:
            self.cache.clear()
            self.use_cache(self.cache)
        cache = self.cache
        fresh = {c for p in parts for c in p if c not in cache}
        if fresh:
            pre = {c: PRETOKEN.findall(c) for c in fresh}
            merged = self.merge_all(list({t for x in pre.values() for t in x}))
            for c, x in pre.items():
                cache[c] = merged[x[0]] if len(x) == 1 else b"".join(map(merged.__getitem__, x))
        return [b"".join(map(cache.__getitem__, p)) for p in parts]

    def encode(self, text: str | None) -> bytes:
        return self.encode_batch([text])[0]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.pieces.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def tokenizer(spec: str) -> ByteBpe:
    return ByteBpe(spec)


def encode_decode(df: DataFrame, tokenizer_json: str) -> DataFrame:
    """See the module text. ``tokenizer_json``: path of the vocabulary file on
    the driver; its content travels as one broadcast (fixed size, about 1.6 MB)."""
    with open(tokenizer_json, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        bpe = tokenizer(spec.value)
        bpe.use_cache(worker_cache("bpe"))
        for b in batches:
            ids = bpe.encode_batch(b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(x) for x in ids], pa.string())],
                names=["doc_id", "ids", "decoded"])

    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, ids binary, decoded string")
