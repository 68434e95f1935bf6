"""N-gram Jaccard join by universe partitions (pigeonhole), verified exactly.

Sets are the distinct 5-word shingles of a text, as 64-bit hashes. Two sets of
sizes r <= s with Jaccard similarity of p % or more differ in at most
H = (100 - p)(r + s) / (100 + p) shingles, and s <= 100 r / p. Sizes fall in bands
so wide that similar sets share a band or lie in neighbouring ones; every set
takes part in its own band and, as the larger side, in the band below.

In a band the universe of hashes is cut into m > H segments. If the segments of
one set get allocations -1 (unused), 0 (must be equal) or 1 (may differ by one
shingle) whose sum of (allocation + 1) exceeds H, every similar set meets one of
the used segments. One side's allocation is enough, so each set picks its own.

1. ``survivors``: a segment whose content no other set has costs nothing and
   finds nothing. Sets with more than H such segments have no similar set at all.
   Segment keys are counted as packed arrays per block of documents and key range;
   a key that a block holds twice is sent once, so hot keys are pre-aggregated.
2. ``allocate``: the survivors' sets are indexed by segment. Each set takes its
   cheapest segments, cost = number of sets with the same key. A set whose
   segments are all costly also indexes one-deletion neighbourhoods, and the
   cost of every option is weighed again (``cheapest_allocation``).
3. ``star_pairs``: in each bucket of a key, members are first paired with the
   most central members only; what is verified joins components.
4. ``cross_pairs``: what the index still pairs across components is compared by
   parity sketches (a lower bound of the difference) and then verified. No
   similar pair is lost, and pairs inside a component are never made.

Verification intersects the two sets of hashes. Equal sets are one class from
the start. Components are found by rounds of joins, never on the driver.

Defined cases: a null text is empty; a text without words has no shingles, is in
no link and is its own component; fewer than five words make one shingle of
all; rows that repeat a doc_id are one node; a row with a null doc_id takes no
part and has a null component; columns other than doc_id and text are ignored.
"""
from __future__ import annotations

import math
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import components, stored

SHINGLE_WORDS = 5
PERCENT = 80
BLOCK_KEYS = 1_000_000      # keys of one block of documents in the survivors' filter
BUCKET_KEYS = 4_000_000     # keys aimed at in one key range
LOOK_KEYS = 200_000         # look-ups of one block of costly sets
COSTLY = 24                 # mean number of other sets from which deletions are weighed
BROADCAST_ROWS = 1_000_000  # survivors up to this many are broadcast (8 MB), else joined
NARROW, WIDE = 1, 4         # bits of a parity sketch per shingle
CROWDED = 32                # sets under a key from which wide sketches are compared
GROUP_CHARS = 2_000_000     # texts shingled in one numpy run
SHARED_IN_BLOCK = 0xFFFF
U64 = np.uint64
MULTIPLIER = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (two multiply-xorshift rounds)."""
    x = (x ^ (x >> U64(31))) * U64(0x7FB5D329728EA185)
    x = (x ^ (x >> U64(27))) * U64(0x81DADEF4BC2DD44D)
    return x ^ (x >> U64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, U64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), U64, len(words))
    width = min(SHINGLE_WORDS, len(words))
    h = np.full(len(words) - width + 1, U64(width))
    with np.errstate(over="ignore"):
        for k in range(width):
            h = mix(h * MULTIPLIER + codes[k:k + len(h)])
    return np.unique(h)


def shingle_runs(texts: list[str | None]):
    """:func:`shingles` of many texts in one numpy run: (sorted distinct hashes of all
    texts one after the other, where each text begins, and the end)."""
    words = [(t or "").encode("utf-8", "replace").lower().split() for t in texts]
    n = np.array([len(w) for w in words], np.int64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(words)), U64, int(n.sum()))
    begin = np.cumsum(n) - n
    width = np.minimum(n, SHINGLE_WORDS)
    count = np.where(n > 0, n - width + 1, 0)
    end = np.cumsum(count)
    # the first word of every shingle; texts of fewer words have one shingle of all
    at = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(begin - (end - count), count)
    wide = np.repeat(width, count)
    h = wide.astype(U64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE_WORDS):
            if (wide > k).all():
                h = mix(h * MULTIPLIER + codes[at + k])
            else:
                some = np.flatnonzero(wide > k)
                h[some] = mix(h[some] * MULTIPLIER + codes[at[some] + k])
    for a, b in zip((end - count).tolist(), end.tolist()):
        h[a:b].sort()
    first = np.ones(len(h), bool)
    first[1:] = h[1:] != h[:-1]
    first[(end - count)[count > 0]] = True
    ends = np.concatenate([[0], np.cumsum(first)])[end] if len(end) else end
    return h[first], np.concatenate([[0], ends]).astype(np.int64)


def text_groups(batch, ids: int = 0, texts: int = 1):
    """(ids, texts) of an Arrow batch in groups of about GROUP_CHARS characters."""
    held: tuple[list, list] = ([], [])
    size = 0
    for i, t in zip(batch.column(ids).to_pylist(), batch.column(texts).to_pylist()):
        held[0].append(i)
        held[1].append(t)
        size += len(t or "")
        if size >= GROUP_CHARS:
            yield held
            held, size = ([], []), 0
    if held[0]:
        yield held


# --- bands and segments ----------------------------------------------------

def difference_bound(r: int, s: int, percent: int = PERCENT) -> int:
    """Most shingles in which similar sets of sizes r and s can differ."""
    return (100 - percent) * (r + s) // (100 + percent)


@lru_cache(maxsize=8)
def band_starts(percent: int, top: int = 1 << 33) -> tuple[int, ...]:
    starts = [1]
    while starts[-1] < top:
        starts.append(starts[-1] * 100 // percent + 1)
    return tuple(starts)


@lru_cache(maxsize=4096)
def segment_bounds(percent: int, band: int) -> np.ndarray:
    """Lower hash bounds of a band's segments: H + 1 and one in eight to spare."""
    largest = band_starts(percent)[band + 1] - 1
    h = difference_bound(largest, largest * 100 // percent, percent)
    m = h + 1 + (h + 1) // 8
    return np.array([(i << 64) // m for i in range(m)], U64)


def roles(n: int, percent: int = PERCENT) -> list[tuple[int, bool, int]]:
    """(band, as the larger side, allocation needed) of a set of n shingles."""
    starts = band_starts(percent)
    band = int(np.searchsorted(starts, n, side="right")) - 1
    out = [(band, False, difference_bound(n, n * 100 // percent, percent) + 1)]
    below = starts[band] - 1
    if band and n <= below * 100 // percent:
        out.append((band - 1, True, difference_bound(below, n, percent) + 1))
    return out


def segments(h: np.ndarray, percent: int, band: int) -> tuple[np.ndarray, np.ndarray]:
    """(key of every segment, first shingle of every segment and the end)."""
    bounds = segment_bounds(percent, band)
    at = np.append(np.searchsorted(h, bounds), len(h))
    with np.errstate(over="ignore"):
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(h), dtype=U64)])
        salt = mix((np.arange(len(bounds), dtype=U64) + U64(band << 32)) * MULTIPLIER)
        return mix(sums[at[1:]] - sums[at[:-1]] + salt), at


def filled_segments(h: np.ndarray, ends: np.ndarray, percent: int):
    """Keys of the filled segments of every role of many sets, as :func:`segments` has
    them: (set of each role, as the larger side, need, filled segments), keys."""
    out = [(k, band, up, need) for k, n in enumerate(np.diff(ends).tolist()) if n for band, up, need in roles(n, percent)]
    if not out:
        return np.zeros((0, 4), np.int64), np.zeros(0, U64)
    sets, bands, ups, needs = (np.array(x, np.int64) for x in zip(*out))
    size = ends[sets + 1] - ends[sets]
    stop = np.cumsum(size)
    role = np.repeat(np.arange(len(sets)), size)
    at = np.arange(int(stop[-1])) + np.repeat(ends[sets] - (stop - size), size)
    segment = np.empty(len(at), np.int64)
    # roles of one band share their bounds
    order = np.argsort(bands, kind="stable")
    for group in np.split(order, np.flatnonzero(np.diff(bands[order])) + 1):
        rows = np.concatenate([np.arange(stop[k] - size[k], stop[k]) for k in group])
        segment[rows] = np.searchsorted(segment_bounds(percent, int(bands[group[0]])), h[at[rows]], side="right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (segment[1:] != segment[:-1]) | (role[1:] != role[:-1])
    first = np.flatnonzero(new)
    with np.errstate(over="ignore"):
        total = np.add.reduceat(mix(h)[at], first)
        salt = mix((segment[first].astype(U64) + (bands[role[first]].astype(U64) << U64(32))) * MULTIPLIER)
        keys = mix(total + salt)
    return np.stack([sets, ups, needs, np.bincount(role[first], minlength=len(sets))], 1), keys


def deletion_keys(h: np.ndarray, at: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, key) of every segment with one of its shingles left out."""
    with np.errstate(over="ignore"):
        token = mix(h)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(token, dtype=U64)])
        seg = np.repeat(np.arange(len(at) - 1), np.diff(at))
        salt = mix((np.arange(len(at) - 1, dtype=U64) + U64(band << 32)) * MULTIPLIER)
        total = sums[at[1:]] - sums[at[:-1]] + salt
        return seg, mix(total[seg] - token)


def parity_sketch(h: np.ndarray, percent: int, band: int, bits: int = WIDE) -> np.ndarray:
    """Bits toggled by the shingles' hashes: two sketches differ in no more bits
    than their sets differ in shingles."""
    largest = band_starts(percent)[band + 1]
    words = max(1, largest * bits // 64)
    bit = mix(h ^ U64(0xA5A5A5A5A5A5A5A5)) % U64(words * 64)
    odd = (np.bincount(bit.astype(np.int64), minlength=words * 64) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8")


# --- 1. survivors ------------------------------------------------------------

def block_id(number: int, *content: bytes) -> int:
    """An id of a task's ``number``-th block: blocks of equal content differ, and a
    task that runs again over the same rows names its blocks the same."""
    place = np.array([TaskContext.get().partitionId(), number], np.int64).tobytes()
    return xxhash.xxh3_64_intdigest(b"".join([place, *content])) >> 1


FILTER_SCHEMA = "bucket int, block long, header boolean, a binary, b binary, c binary, d binary, e binary"


def _filter_rows(percent: int, buckets: int):
    """Blocks of documents as packed rows: per key range the keys and the
    document roles they belong to; one header row with ids, sizes and needs."""

    def rows_of(number, ids, sizes, marks, parts, owners):
        doc = np.array(ids, np.int64)
        block = block_id(number, doc.tobytes(), *marks)
        need = np.array([o[1] for o in owners], np.int64)
        counts = np.array([len(p) for p in parts], np.int64)
        keys = np.concatenate(parts) if parts else np.zeros(0, U64)
        owner = np.repeat(np.arange(len(owners)), counts)
        order = np.argsort(keys, kind="stable")
        keys, owner = keys[order], owner[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(keys)))
        distinct = keys[first]
        who = np.where(times == 1, owner[first], SHARED_IN_BLOCK).astype(np.uint16)
        alone = np.bincount(owner[first[times == 1]], minlength=len(owners))[:len(owners)]
        cut = np.searchsorted(distinct, np.array([(b << 64) // buckets for b in range(buckets)], U64))
        cut = np.append(cut, len(distinct))
        yield (block % buckets, block, True, doc.tobytes(), np.array(sizes, np.int64).tobytes(),
               np.array([o[0] for o in owners], np.int64).tobytes(), (alone - need).astype(np.int64).tobytes(),
               b"".join(marks))
        low = distinct.astype(np.uint32)  # within a key range 32 bits tell keys apart well enough
        for b in range(buckets):
            s = slice(cut[b], cut[b + 1])
            if cut[b + 1] > cut[b]:
                yield b, block, False, low[s].tobytes(), who[s].tobytes(), None, None, None

    def run(batches):
        ids, sizes, marks, parts, owners, n_keys = [], [], [], [], [], 0
        number = 0
        out: list[tuple] = []

        def batch():
            cols = list(zip(*out))
            out.clear()
            types = [pa.int32(), pa.int64(), pa.bool_()] + [pa.binary()] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["bucket", "block", "header", "a", "b", "c", "d", "e"])

        for b in batches:
            for some, texts in text_groups(b):
                h, ends = shingle_runs(texts)
                found, keys = filled_segments(h, ends, percent)
                if len(owners) + len(found) >= SHARED_IN_BLOCK - 4 and ids:
                    out.extend(rows_of(number, ids, sizes, marks, parts, owners))
                    ids, sizes, marks, parts, owners, n_keys = [], [], [], [], [], 0
                    number += 1
                    yield batch()
                owners.extend((len(ids) + k, need) for k, _, need, _ in found.tolist())
                parts.extend(np.split(keys, np.cumsum(found[:-1, 3])) if len(found) else [])
                n_keys += len(keys)
                ids.extend(some)
                sizes.extend(np.diff(ends).tolist())
                marks.extend(xxhash.xxh3_128_digest(h[x:y].tobytes()) for x, y in zip(ends.tolist(), ends[1:].tolist()))
                if n_keys >= BLOCK_KEYS:
                    out.extend(rows_of(number, ids, sizes, marks, parts, owners))
                    ids, sizes, marks, parts, owners, n_keys = [], [], [], [], [], 0
                    number += 1
                    yield batch()
        if ids:
            out.extend(rows_of(number, ids, sizes, marks, parts, owners))
            yield batch()

    return run


def _count_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
    """Roles whose key is held by another block; header rows pass through."""
    keys = pdf[~pdf["header"]]
    out = [pdf[pdf["header"]]]
    if len(keys):
        parts = [np.frombuffer(x, np.uint32) for x in keys["a"]]
        distinct, times = np.unique(np.concatenate(parts), return_counts=True)
        shared = distinct[times > 1]
        found = []
        for p, who in zip(parts, keys["b"]):
            owner = np.frombuffer(who, np.uint16)
            k = np.searchsorted(shared, p)
            hit = (k < len(shared)) & (owner != SHARED_IN_BLOCK)
            hit[hit] = shared[k[hit]] == p[hit]
            found.append(owner[hit].tobytes())
        out.append(keys.assign(a=found, b=None))
    return pd.concat(out)


def _finish_block(pdf: pd.DataFrame) -> pd.DataFrame:
    """(doc_id, n_shingles, print, survives) of a block's documents."""
    head = pdf[pdf["header"]].iloc[0]
    doc, sizes, owner, spare = (np.frombuffer(head[c], np.int64) for c in "abcd")
    lost = np.zeros(len(owner), np.int64)
    for x in pdf.loc[~pdf["header"], "a"]:
        lost += np.bincount(np.frombuffer(x, np.uint16), minlength=len(owner))
    survives = np.zeros(len(doc), bool)
    survives[owner[spare - lost < 0]] = True
    marks = [head["e"][k:k + 16] for k in range(0, 16 * len(doc), 16)]
    return pd.DataFrame({"doc_id": doc, "n_shingles": sizes, "print": marks, "survives": survives})


def survivors(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, print, survives) for docs(doc_id, text) without null
    ids; ``print`` is a 128-bit hash of the whole set."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about 6.5 bytes a word and 0.55 keys a shingle
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(size * 0.085 / BUCKET_KEYS))
    rows = docs.mapInArrow(_filter_rows(percent, buckets), FILTER_SCHEMA)
    counted = rows.groupBy("bucket").applyInPandas(_count_bucket, FILTER_SCHEMA)
    return counted.groupBy("block").applyInPandas(_finish_block, "doc_id long, n_shingles long, print binary, survives boolean")


# --- 2. allocation -----------------------------------------------------------

def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _packed(names: str, types, columns):
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)).cast(t) for c, t in zip(columns, types)],
                                      names=names.split())


def _segment_rows(percent: int):
    """Every filled segment of every role of sets(sid, set): its key, and how many
    filled segments the role has beyond its need."""

    def run(batches):
        for b in batches:
            h = [np.frombuffer(raw, U64) for raw in b.column(1).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in h])]).astype(np.int64)
            found, keys = filled_segments(np.concatenate([*h, np.zeros(0, U64)]), ends, percent)
            if len(found):
                sid = b.column(0).to_numpy()[found[:, 0]]
                cols = [np.repeat(x, found[:, 3]) for x in (sid, found[:, 1], found[:, 3] - found[:, 2])]
                yield _packed("sid up spare key", (pa.int64(), pa.bool_(), pa.int32(), pa.int64()),
                              [[x] for x in (*cols, _as_long(keys))])

    return run


def cheapest_allocation(need: int, plain: dict[int, int], loose: dict[int, int]) -> dict[int, int]:
    """Allocations 0 or 1 by segment whose gains (allocation + 1) reach ``need``.

    ``plain`` and ``loose`` hold the cost of allocation 0 and 1 of each segment.
    Steps are taken in order of marginal cost; a segment's second step follows its
    first. All segments at 0 always suffice, as there are more than H of them.
    """
    steps = sorted([(c, 0, s) for s, c in plain.items()]
                   + [(max(loose[s] - c, c), 1, s) for s, c in plain.items() if s in loose])
    taken: dict[int, int] = {}
    for _, level, s in steps[:max(need, 0)]:
        taken[s] = max(taken.get(s, 0), level)
    return taken


# Name spaces of look-ups: keys among all sets (plain), and among costly sets their
# keys (0) and one-deletion neighbourhoods (1).
SPACE = (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D)


LOOK_SCHEMA = "bucket int, block long, header boolean, " + ", ".join(f"{c} binary" for c in "abcdefg")


def _look_rows(percent: int, buckets: int):
    """Look-ups of costly roles (sid, up, set) in packed blocks: kind 0 a segment
    as it is (an empty one too), kind 1 one with a shingle left out. A block sends
    each of its keys once per key range, with counts by kind, so hot keys are
    pre-aggregated; its own look-ups travel beside them in one header row."""

    def rows_of(number, sids, ups, sizes, parts):
        keys, kinds, segs = (np.concatenate([p[c] for p in parts]) for c in range(3))
        owner = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        ids = np.array(sids, np.int64).tobytes() + np.array(ups, np.uint8).tobytes()
        block = block_id(number, ids)
        yield (block % buckets, block, True, np.array(sids, np.int64).tobytes(), np.array(ups, np.uint8).tobytes(),
               np.array(sizes, np.int64).tobytes(), keys.tobytes(), kinds.astype(np.uint8).tobytes(),
               segs.astype(np.uint32).tobytes(), owner.astype(np.uint32).tobytes())
        distinct, at = np.unique(keys, return_inverse=True)
        less = np.bincount(at, kinds, len(distinct)).astype(np.uint32)
        exact = (np.bincount(at, minlength=len(distinct)) - less).astype(np.uint32)
        cut = np.searchsorted(distinct, np.array([(b << 64) // buckets for b in range(buckets)], U64))
        cut = np.append(cut, len(distinct))
        for b in range(buckets):
            s = slice(cut[b], cut[b + 1])
            if cut[b + 1] > cut[b]:
                yield (b, block, False, distinct[s].tobytes(), exact[s].tobytes(), less[s].tobytes(), *[None] * 4)

    def run(batches):
        held: tuple[list, ...] = ([], [], [], [])
        number, n_keys = 0, 0

        def batch():
            cols = list(zip(*rows_of(number, *held)))
            for h in held:
                h.clear()
            types = [pa.int32(), pa.int64(), pa.bool_()] + [pa.binary()] * 7
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                              names=["bucket", "block", "header", *"abcdefg"])

        for b in batches:
            for sid, up, raw in zip(*(c.to_pylist() for c in b.columns)):
                h = np.frombuffer(raw, U64)
                band = next(x[0] for x in roles(len(h), percent) if x[1] == up)
                keys, at = segments(h, percent, band)
                seg, less = deletion_keys(h, at, band)
                for c, v in zip(held, (sid, up, len(h), (np.concatenate([keys, less]), np.repeat(
                        [0, 1], [len(keys), len(less)]), np.concatenate([np.arange(len(keys)), seg])))):
                    c.append(v)
                n_keys += len(keys) + len(less)
                if n_keys >= LOOK_KEYS:
                    n_keys = 0
                    yield batch()
                    number += 1
        if held[0]:
            yield batch()

    return run


def _count_looks(pdf: pd.DataFrame) -> pd.DataFrame:
    """Counts of a key range over all blocks, given back to each block."""
    rows = pdf[~pdf["header"]]
    out = [pdf[pdf["header"]]]
    if len(rows):
        keys = [np.frombuffer(x, U64) for x in rows["a"]]
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = [np.bincount(at, np.concatenate([np.frombuffer(x, np.uint32) for x in rows[c]]), len(distinct))
                  .astype(np.int64) for c in "bc"]
        where = [np.searchsorted(distinct, k) for k in keys]
        out.append(rows.assign(b=[totals[0][w].tobytes() for w in where], c=[totals[1][w].tobytes() for w in where]))
    return pd.concat(out)


def _allocate_block(percent: int):
    """(sid, up, probes, index) of a block's roles: the folded keys that each looks
    under, by its cheapest allocation, and is found under."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        head = pdf[pdf["header"]].iloc[0]
        rows = pdf[~pdf["header"]]
        known = np.concatenate([np.frombuffer(x, U64) for x in rows["a"]])
        order = np.argsort(known)
        known = known[order]
        exact, less = (np.concatenate([np.frombuffer(x, np.int64) for x in rows[c]])[order] for c in "bc")
        sids, ups, sizes, keys, kinds, segs, owner = (np.frombuffer(head[c], t) for c, t in zip(
            "abcdefg", (np.int64, np.uint8, np.int64, U64, np.uint8, np.uint32, np.uint32)))
        at = np.searchsorted(known, keys)
        exact, less = exact[at], less[at]
        ends = np.append(np.searchsorted(owner, np.arange(len(sids))), len(owner))
        out = []
        for k, (sid, up, n) in enumerate(zip(sids.tolist(), ups.tolist(), sizes.tolist())):
            s = slice(ends[k], ends[k + 1])
            need = next(x[2] for x in roles(n, percent) if x[1] == bool(up))
            kind, seg, ex, le = kinds[s], segs[s].astype(np.int64), exact[s], less[s]
            # what allocation 0 and 1 of a segment would meet, itself left out
            m = int(seg.max()) + 1
            plain = np.bincount(seg, np.where(kind == 0, ex - 1, 0), m)
            extra = np.bincount(seg, np.where(kind == 0, le, ex), m)
            taken = cheapest_allocation(need, dict(enumerate(plain.tolist())), dict(enumerate((plain + extra).tolist())))
            level = np.full(m, -1)
            level[list(taken)] = list(taken.values())
            level = level[seg]
            # allocation 0: the key among keys; 1: also among the others' deletions,
            # and the own deletions among keys
            among_keys = (ex > (kind == 0)) & ((kind == 0) & (level >= 0) | (kind == 1) & (level == 1))
            among_deletions = (kind == 0) & (level == 1) & (le > 0)
            own = _as_long(keys[s])
            probes = np.concatenate([own[among_keys] ^ SPACE[0], own[among_deletions] ^ SPACE[1]])
            out.append((sid, bool(up), probes, own ^ np.where(kind == 0, SPACE[0], SPACE[1])))
        return pd.DataFrame(out, columns=["sid", "up", "probes", "index"])

    return run


def allocate(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(sid, up, score, probes, index) of every role of the distinct sets(sid, n,
    set) that may have a similar set: the keys that it looks under, the keys that
    it is found under, and how central it is (mean log of its keys' counts)."""
    rows = sets.select("sid", "set").mapInArrow(_segment_rows(percent), "sid long, up boolean, spare int, key long")
    often = rows.groupBy("key").agg(F.count("*").cast("int").alias("sets")).where("sets > 1")
    held = rows.join(often, "key").groupBy("sid", "up").agg(
        F.max("spare").alias("spare"), F.avg(F.log("sets")).alias("score"),
        F.sort_array(F.collect_list(F.struct("sets", "key"))).alias("keys"))  # at most its segments
    # a role whose unshared segments meet the need has no similar set in the band
    held = held.withColumn("left", F.size("keys") - F.col("spare")).where("left > 0")
    chosen = F.slice("keys", 1, F.greatest(F.least(F.col("left"), F.size("keys")), F.lit(1)))
    cost = F.aggregate(chosen, F.lit(0).cast("long"), lambda t, x: t + x["sets"] - 1)
    held = held.withColumn("costly", (F.col("left") > F.size("keys")) | (cost > F.col("left") * COSTLY))
    held = stored(held.select("sid", "up", "left", "score", "costly", F.transform("keys", lambda k: k["key"]).alias("keys")),
                  "near-held", release=True)
    # a key range gets about BUCKET_KEYS look-ups: a costly role has its segments' keys and one per shingle
    size = held.where("costly").select("sid").join(sets.select("sid", "n"), "sid").agg(F.sum("n")).first()[0] or 0
    buckets = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(1.6 * size / BUCKET_KEYS))
    looks = held.where("costly").select("sid", "up").join(sets, "sid").select("sid", "up", "set").mapInArrow(
        _look_rows(percent, buckets), LOOK_SCHEMA)
    own = looks.groupBy("bucket").applyInPandas(_count_looks, LOOK_SCHEMA).groupBy("block").applyInPandas(
        _allocate_block(percent), "sid long, up boolean, probes array<long>, index array<long>")
    # every set is found by the cheap ones; costly ones also look for each other
    both = held.join(own.withColumnsRenamed({"probes": "own_probes", "index": "own_index"}), ["sid", "up"], "left")
    empty = F.array().cast("array<long>")
    return stored(both.select(
        "sid", "up", "score",
        F.when(F.col("costly"), F.coalesce("own_probes", empty)).otherwise(
            F.slice("keys", 1, F.greatest("left", F.lit(1)))).alias("probes"),
        F.concat("keys", F.coalesce("own_index", empty)).alias("index")), "near-roles", release=True)


# --- 3. and 4. pairs -----------------------------------------------------------

LEADERS = 3


def star_pairs(allocated: DataFrame) -> DataFrame:
    """(a, b): every probe with the most central sets that look under its key."""
    probes = allocated.select("sid", "score", F.explode("probes").alias("key"))
    leaders = probes.groupBy("key").agg(*[
        F.max(F.when(F.pmod(F.xxhash64("sid"), F.lit(LEADERS)) == j, F.struct("score", "sid"))).alias(f"l{j}")
        for j in range(LEADERS)])
    pairs = probes.select("key", "sid").join(leaders, "key").select(
        "sid", F.explode(F.array_compact(F.array(*[F.col(f"l{j}.sid") for j in range(LEADERS)]))).alias("l"))
    return pairs.where("sid <> l").select(F.least("sid", "l").alias("a"), F.greatest("sid", "l").alias("b")).distinct()


def _may_be_similar(percent: int):
    """Size and parity bounds of two sides n_p, sketch_p and n_i, sketch_i."""
    differing = F.aggregate(F.zip_with("sketch_p", "sketch_i", lambda x, y: F.bit_count(x.bitwiseXOR(y))),
                            F.lit(0), lambda t, x: t + x)
    return (F.greatest("n_p", "n_i") * percent <= F.least("n_p", "n_i") * 100) \
        & (differing * (100 + percent) <= (F.col("n_p") + F.col("n_i")) * (100 - percent))


def plausible(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that their sizes and some common band's sketches allow."""
    p = sketches.select(F.col("sid").alias("a"), "band", F.col("n").alias("n_p"), F.col("wide").alias("sketch_p"))
    i = sketches.select(F.col("sid").alias("b"), "band", F.col("n").alias("n_i"), F.col("wide").alias("sketch_i"))
    return pairs.join(p, "a").join(i, ["b", "band"]).where(_may_be_similar(percent)).select("a", "b").distinct()


def cross_pairs(allocated: DataFrame, sketches: DataFrame, component: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b): what the index pairs across components and sketches don't exclude.

    Under each key the largest component's members ("big") meet the other ones,
    and these meet each other, but the big ones never meet among themselves.
    """
    of = component.select(F.col("node").alias("sid"), "component")
    named = allocated.join(of, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    every = named.select("component", F.lit(False).alias("probe"), F.explode("index").alias("key")).unionByName(
        named.select("component", F.lit(True).alias("probe"), F.explode("probes").alias("key")))
    met = every.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"),
                                   F.max("probe").alias("probed"), F.count("*").alias("rows")) \
        .where("probed and lo < hi").select("key", (F.col("rows") >= CROWDED).alias("crowded"))
    met = stored(met, "near-met", release=True)
    if met.count() <= BROADCAST_ROWS:
        met = F.broadcast(met)
    drawn = named.join(sketches.select("sid", "up", "n", "narrow", "wide"), ["sid", "up"])
    what = ["sid", "up", "component", "n", "narrow", "wide"]
    rows = drawn.select(*what, F.lit(False).alias("probe"), F.explode("index").alias("key")).unionByName(
        drawn.select(*what, F.lit(True).alias("probe"), F.explode("probes").alias("key"))).join(met, "key").select(
        "key", "sid", "up", "component", "n", "probe", F.when(F.col("crowded"), F.col("wide")).otherwise(
            F.col("narrow")).alias("sketch"))
    big = rows.where("not probe").groupBy("key", "component").count().groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("big"))
    tagged = rows.join(big, "key", "left").withColumn("is_big", F.coalesce(F.col("component") == F.col("big"), F.lit(False)))

    def side(x: str, *more):
        return [F.col(c).alias(c + x) for c in ("component", "sid", "up", "n", "sketch")] + list(more)

    p = tagged.where("probe").select("key", *side("_p"), F.explode(
        F.when(F.col("is_big"), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))).alias("is_big"))
    i = tagged.where("not probe").select("key", "is_big", *side("_i"))
    may = (F.col("component_p") != F.col("component_i")) & ~(F.col("up_p") & F.col("up_i")) & _may_be_similar(percent)
    out = p.join(i, (p["key"] == i["key"]) & (p["is_big"] == i["is_big"]) & may)
    return out.select(F.least("sid_p", "sid_i").alias("a"), F.greatest("sid_p", "sid_i").alias("b")).distinct()


def _verify_rows(percent: int):
    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                x, y = np.frombuffer(x, U64), np.frombuffer(y, U64)
                if len(x) > len(y):
                    x, y = y, x
                k = np.searchsorted(y, x)
                both = int((y[np.minimum(k, len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], names=["a", "b"])

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets are similar, by exact intersection."""
    x = sets.select(F.col("sid").alias("a"), F.col("set").alias("x"))
    y = sets.select(F.col("sid").alias("b"), F.col("set").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_verify_rows(percent), "a long, b long")


def _set_rows(batches):
    for b in batches:
        for ids, texts in text_groups(b):
            h, ends = shingle_runs(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.column(0).type), pa.array(np.diff(ends)),
                 pa.array([h[x:y].tobytes() for x, y in zip(ends.tolist(), ends[1:].tolist())], pa.binary())],
                names=["sid", "n", "set"])


def _printed_rows(batches):
    for b in _set_rows(batches):
        marks = [xxhash.xxh3_128_digest(x) for x in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(marks, pa.binary()), b.column(1), b.column(2)], names=["print", "n", "set"])


def _sketch_rows(percent: int):
    def run(batches):
        for b in batches:
            rows = [(sid, up, band, len(raw) // 8, *(parity_sketch(np.frombuffer(raw, U64), percent, band, bits)
                                                     for bits in (NARROW, WIDE)))
                    for sid, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist())
                    for band, up, _ in roles(len(raw) // 8, percent)]
            cols = list(zip(*rows)) or [[]] * 6
            types = (pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                             names=["sid", "up", "band", "n", "narrow", "wide"])

    return run


def similar_documents(df: DataFrame, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents, links): documents (doc_id, n_shingles, component_id), one per
    row of ``df``; links (a, b) between representatives of distinct sets and
    between a representative and its equal documents, which connect exactly the
    documents that similarity connects (not every similar pair is listed)."""
    docs = df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = docs.where("doc_id is not null")
    sizes = stored(survivors(named, percent), "near-sizes", release=True)
    alive = sizes.where("survives").select("doc_id", "print")
    classes = alive.groupBy("print").agg(F.min("doc_id").alias("doc_id"))
    often = sizes.groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("often"))
    repeats = not often.isEmpty()
    if repeats:  # a doc_id may name several sets: each goes by its own id
        classes = classes.join(often, "doc_id", "left").select(
            "print", "doc_id", F.coalesce("often", F.lit(False)).alias("often"), F.monotonically_increasing_id().alias("sid"))
    else:
        classes = classes.select("print", "doc_id", F.lit(False).alias("often"), F.col("doc_id").alias("sid"))
    classes = stored(classes, "near-classes")
    copies = alive.join(classes.select("print", F.col("doc_id").alias("a")), "print").where("doc_id <> a") \
        .select("a", F.col("doc_id").alias("b")).distinct()
    ids = classes.where("not often").select("doc_id", "sid")
    if ids.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    sets = named.join(ids, "doc_id").select("sid", "text").mapInArrow(_set_rows, "sid long, n long, set binary")
    if repeats:
        several = classes.where("often")
        found = named.join(several.select("doc_id").distinct(), "doc_id").mapInArrow(
            _printed_rows, "print binary, n long, set binary").dropDuplicates(["print"])
        sets = sets.unionByName(found.join(several.select("print", "sid"), "print").select("sid", "n", "set"))
    sets = stored(sets.where("n > 0"), "near-sets", release=True)
    allocated = allocate(sets, percent)
    sketches = stored(sets.select("sid", "set").mapInArrow(
        _sketch_rows(percent), "sid long, up boolean, band int, n long, narrow array<long>, wide array<long>"), "near-sketches")
    stars = stored(plausible(star_pairs(allocated), sketches, percent), "near-stars", release=True)
    links = stored(verified(stars, sets, percent), "near-links", release=True)
    rest = stored(cross_pairs(allocated, sketches, components(links), percent), "near-rest", release=True)
    links = links.unionByName(verified(rest, sets, percent))
    if repeats:
        x, y = (classes.select(F.col("sid").alias(c), F.col("doc_id").alias(f"doc_{c}")) for c in "ab")
        links = links.join(x, "a").join(y, "b").where("doc_a <> doc_b").select(
            F.least("doc_a", "doc_b").alias("a"), F.greatest("doc_a", "doc_b").alias("b")).distinct()
    links = stored(links.unionByName(copies), "near-all-links", release=True)
    of = components(links)
    out = sizes.join(of, sizes["doc_id"] == of["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    unnamed = docs.where("doc_id is null").mapInArrow(_set_rows, "sid long, n long, set binary").select(
        F.col("sid").alias("doc_id"), F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(unnamed), links


def one_of_each(df: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``df`` without the documents that a smaller doc_id of their component
    stands for. Of rows that repeat doc_id and text one stays; texts without
    words and rows without a doc_id stay."""
    found, _ = similar_documents(df, percent)
    found = stored(found.where("doc_id is not null"), "near-found")
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    few = gone.count() <= BROADCAST_ROWS
    rest = df.join(F.broadcast(gone) if few else gone, df["doc_id"].cast("long") == gone["_gone"], "left_anti")
    # rows that repeat a doc_id are rare: only then are rows compared
    if found.groupBy("doc_id").count().where("count > 1").isEmpty():
        return rest
    unnamed = rest.where("doc_id is null")
    return rest.where("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(unnamed)
