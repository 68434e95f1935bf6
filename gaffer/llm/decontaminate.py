"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A benchmark item's windows are its runs of ``WINDOW`` consecutive words; an item of fewer
words is one window. Every place in a document where all words of a window stand one after
the other is an occurrence; its words are hit.

Words become numbers of the patterns' vocabulary, 0 for all others, so that
numbers are equal just where words are. Patterns of one length m are searched together:

* shift table: for the (hashed) block of the last words under a search position, how far the
  position may move without passing the end of an occurrence, at most m - block + 1;
* suffix-hash buckets: where the shift is 0, the patterns that end in that block,
  kept in order of the hash of their first words, which picks the few to test;
* direct comparison of all m numbers confirms an occurrence.

Positions move in lockstep: a batch of documents is cut in lanes that overlap by m - 1
words, and all lanes take their own shift at each step.

The benchmark is cut in blocks of at most about ``BLOCK_BYTES`` of text (long items overlap at
the cuts, so no window is lost); a block's tables are broadcast, and documents are searched
once per block. With one block nothing is shuffled; else hits are merged by
document and only documents with hits are shuffled.

Defined cases: A-Z are lower-cased, other letters are not; null and empty texts have no words
and no hit; items without words have no window; items of one id are one item, a null id counts
as the id ``""``; rows that repeat doc_id and text get equal results; an empty benchmark
hits nothing; other columns are ignored.
"""
from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import stored

WINDOW = 10
BLOCK_BYTES = 8 << 20
CHUNK_WORDS = 5_000
LANE = 256
PAIRS_AT_ONCE = 1 << 20
# [0-9A-Za-z] and everything beyond ASCII are word bytes; the rest, and case, is folded away
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(FOLD).split()


def hash_runs(ids: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` numbers from each start on."""
    h = np.zeros(len(starts), np.uint64)
    for k in range(size):
        h = (h ^ ids[starts + k].astype(np.uint64)) * MIX
        h ^= h >> np.uint64(29)
    return h


class PatternSet:
    """Shift table and suffix buckets of the patterns of one length."""

    def __init__(self, patterns: np.ndarray, owners: list[list[str]]):
        """Different patterns (one a row), and the items that each belongs to."""
        n, self.m = patterns.shape
        # blocks of two words, of three where two would leave crowded buckets
        self.block = min(self.m, 2 if n < 20_000 else 3)
        flat, rows = patterns.ravel(), np.arange(n) * self.m
        bits = max(10, int(n * (self.m - self.block + 1)).bit_length() + 2)
        self.mask = np.uint64((1 << bits) - 1)
        self.most = self.m - self.block + 1
        self.shift = np.full(1 << bits, self.most, np.int64)
        for at in range(self.most - 1, -1, -1):
            slot = (hash_runs(flat, rows + at, self.block) & self.mask).astype(np.int64)
            np.minimum.at(self.shift, slot, self.most - 1 - at)
        suffix = hash_runs(flat, rows + self.most - 1, self.block) & self.mask
        key = self.key(suffix, hash_runs(flat, rows, self.block))
        order = np.argsort(key, kind="stable")
        self.keys, self.patterns = key[order], patterns[order]
        self.owners = [owners[k] for k in order]

    @staticmethod
    def key(suffix: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        return (suffix << np.uint64(32)) | (prefix >> np.uint64(32))

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, patterns) of all occurrences in ids."""
        none = np.zeros(0, np.int64)
        if len(ids) < self.m:
            return none, none
        # search positions are starts of the window's last block
        lanes = np.arange(self.most - 1, len(ids) - self.block + 1, LANE)
        ends = np.minimum(lanes + LANE, len(ids) - self.block + 1)
        stops = []
        while len(lanes):
            jump = self.shift[(hash_runs(ids, lanes, self.block) & self.mask).astype(np.int64)]
            stops.append(lanes[jump == 0])
            lanes = lanes + np.maximum(jump, 1)
            going = lanes < ends
            lanes, ends = lanes[going], ends[going]
        at = np.concatenate(stops)
        starts = at - (self.most - 1)
        key = self.key(hash_runs(ids, at, self.block) & self.mask, hash_runs(ids, starts, self.block))
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        found_at, found = [none], [none]
        counts = high - low
        total = np.cumsum(counts)
        a = 0
        while a < len(starts):  # tests in groups of bounded size
            before = total[a - 1] if a else 0
            b = max(a + 1, int(np.searchsorted(total, before + PAIRS_AT_ONCE, "right")))
            place = np.repeat(starts[a:b], counts[a:b])
            offset = np.arange(len(place)) - np.repeat(total[a:b] - counts[a:b] - before, counts[a:b])
            pattern = np.repeat(low[a:b], counts[a:b]) + offset
            for k in range(self.m):
                same = ids[place + k] == self.patterns[pattern, k]
                place, pattern = place[same], pattern[same]
            found_at.append(place)
            found.append(pattern)
            a = b
        return np.concatenate(found_at), np.concatenate(found)


class Index:
    """All patterns of one block of the benchmark."""

    def __init__(self, pieces: list[tuple[str, list[bytes]]]):
        """(item, words) of each piece; a piece of WINDOW words or more has all its windows."""
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, words in pieces:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            size = min(WINDOW, len(ids))
            for k in range(len(ids) - size + 1 if size else 0):
                by_length[size][tuple(ids[k:k + size])].add(item)
        self.sets = [PatternSet(np.array(list(p), np.int32).reshape(len(p), m), [sorted(x) for x in p.values()])
                     for m, p in sorted(by_length.items())]

    def search(self, docs: list[list[bytes]]):
        """For each document: (starts, ends) of its hit runs of words and its items."""
        sizes = np.array([len(d) for d in docs], np.int64)
        # documents stand one after the other, parted by a number that no pattern has
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        ids = np.zeros(int((sizes + 1).sum()), np.int32)
        get = self.vocabulary.get
        for d, b, n in zip(docs, begin.tolist(), sizes.tolist()):
            ids[b:b + n] = [get(w, 0) for w in d]
        change = np.zeros(len(ids) + 1, np.int64)
        items: dict[int, set[str]] = defaultdict(set)
        for s in self.sets:
            starts, patterns = s.find(ids)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + s.m, -1)
            doc = np.searchsorted(begin, starts, "right") - 1
            for d, p in np.unique(np.stack([doc, patterns], 1), axis=0).tolist():
                items[d].update(s.owners[p])
        hit = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
        edges = np.flatnonzero(np.diff(hit))
        first, last = edges[::2], edges[1::2]
        owner = np.searchsorted(begin, first, "right") - 1
        runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for d, a, b in zip(owner.tolist(), first.tolist(), last.tolist()):
            runs[d].append((a - int(begin[d]), b - int(begin[d])))
        return [(runs.get(d, []), sorted(items.get(d, ()))) for d in range(len(docs))]


SPANS = "array<struct<first:long,last:long>>"
SPAN_TYPE = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def _search(index, keys: int, hits_only: bool):
    """Rows of ``keys`` columns and a text -> the keys, n_words, spans, items."""
    def run(batches):
        built = Index(index.value)
        for b in batches:
            docs = [words_of(t) for t in b.column(keys).to_pylist()]
            found = built.search(docs)
            keep = pa.array([bool(spans) or not hits_only for spans, _ in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([
                *b.columns[:keys], pa.array([len(d) for d in docs], pa.int64()),
                pa.array([[{"first": a, "last": z - 1} for a, z in spans] for spans, _ in found], SPAN_TYPE),
                pa.array([x for _, x in found], pa.list_(pa.string()))],
                names=[*b.schema.names[:keys], "n_words", "spans", "items"]).filter(keep)
    return run


def pieces_of(benchmark: DataFrame) -> DataFrame:
    """(item, no, text): the items' texts, the long ones in overlapping pieces."""
    def run(batches):
        for b in batches:
            out = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                for no, k in enumerate(range(0, max(1, len(words) - WINDOW + 1), CHUNK_WORDS)):
                    part = words[k:k + CHUNK_WORDS + WINDOW - 1]
                    if part:
                        out.append((item, no, b" ".join(part).decode()))
            cols = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string()))],
                                             names=["item", "no", "text"])
    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.col("text").cast("string").alias("text")).mapInArrow(run, "item string, no long, text string")


def merged(spans):
    """Runs of words that overlap or touch, merged."""
    def add(done, x):
        last = F.get(done, F.size(done) - 1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["last"], x["last"]).alias("last"))
        return F.when((F.size(done) > 0) & (x["first"] <= last["last"] + 1),
                      F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))) \
            .otherwise(F.concat(done, F.array(x)))
    return F.aggregate(F.array_sort(spans), F.lit([]).cast(SPANS), add)


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, spans (first and last word of each hit run) and items (found in
    the document, in string order), one row per document."""
    spark = docs.sparkSession
    pieces = stored(pieces_of(benchmark).distinct(), "bench-pieces")
    size = pieces.agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    text = F.col("text").cast("string").alias("text")

    def index(k):
        mine = pieces.where(F.pmod(F.xxhash64("item", "no"), F.lit(blocks)) == k)
        return spark.sparkContext.broadcast([(r.item, r.text.encode().split()) for r in mine.select("item", "text").collect()])

    schema = "n_words long, spans " + SPANS + ", items array<string>"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    if blocks == 1:
        return docs.select("doc_id", text).mapInArrow(_search(index(0), 1, False), f"doc_id {id_type}, {schema}")
    # equal rows have equal hits, so a hash of the text is as good as a row number
    hashed = docs.select("doc_id", F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"), text)
    found = None
    for k in range(blocks):
        part = stored(hashed.mapInArrow(_search(index(k), 3, True), f"doc_id {id_type}, h1 long, h2 long, {schema}"), "bench-hits")
        found = part if found is None else found.unionByName(part)
    hits = found.groupBy("doc_id", "h1", "h2").agg(F.flatten(F.collect_set("spans")).alias("spans"),
                                                   F.flatten(F.collect_set("items")).alias("items"))
    hits = hits.select(F.col("doc_id").alias("_doc_id"), F.col("h1").alias("_h1"), F.col("h2").alias("_h2"),
                       merged(F.col("spans")).alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))

    def count(batches):
        for b in batches:
            n = pa.array([len(words_of(t)) for t in b.column(3).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns[:3], n], names=[*b.schema.names[:3], "n_words"])
    counted = hashed.mapInArrow(count, f"doc_id {id_type}, h1 long, h2 long, n_words long")
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    return counted.join(hits, same, "left").select(
        "doc_id", "n_words", F.coalesce("spans", F.lit([]).cast(SPANS)).alias("spans"),
        F.coalesce("items", F.lit([]).cast("array<string>")).alias("items"))


def report(found: DataFrame) -> DataFrame:
    """The contract's figures of what ``decontaminate`` finds."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["last"] - x["first"] + 1)
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


# Windows of words as lists, joined to windows of the documents; hits are counted by word.
ORACLE_SQL = """
WITH
item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, w[k:k + least(len(w), 10) - 1] AS piece
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS k FROM item WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(piece) AS m FROM windows),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w
  FROM documents),
places AS (
  SELECT rid, m, k, w[k:k + m - 1] AS piece
  FROM (SELECT rid, w, m, unnest(range(1, greatest(len(w) - m, -1) + 2)) AS k FROM doc, sizes)),
found AS (SELECT p.rid, p.m, p.k, w.item FROM places p JOIN windows w ON w.piece = p.piece),
hits AS (
  SELECT rid, count(DISTINCT word) AS n_hit
  FROM (SELECT rid, unnest(range(k, k + m)) AS word FROM (SELECT DISTINCT rid, m, k FROM found)) GROUP BY rid),
items AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(i.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(i.names, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hits h USING (rid) LEFT JOIN items i USING (rid)
"""
