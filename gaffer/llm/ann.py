"""Nearest neighbours by cosine: a block matrix join of int8 product tiles.

Vectors are scaled to length 1 and coded in int8. Queries and candidates are
packed in blocks; a tile, one query block by one candidate block, is one matrix
product of codes. Each code's error norm is known, so a tile gives every cosine
with a bound: |u.v - code| <= (1 + e_u) e_v + e_u. Pairs whose upper bound reaches
the k-th best lower bound (or the query's k-th best score so far) survive and are
recomputed on the original vectors in double precision; heaps keep each query's k
best, within a task over all its tiles, then over tasks. The result is exact.

Tiles are the only place where queries meet candidates. Query blocks are broadcast, about
``BROADCAST_BYTES`` at a time; the candidate blocks stay where they are and are read once for each
such part of the queries.

Defined cases: vectors that are null, empty, zero or that hold null or non-finite
components take no part; only vectors of equal dimension meet; rows with a null
id take no part; of rows that repeat an id the least vector counts; a query with
fewer than k candidates gets all; other columns are ignored.
"""
from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaffer.llm.common import stored

QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 4096
BROADCAST_BYTES = 16 << 20
EXACT_DIMENSIONS = 1024  # sums of that many products of int8 are exact in float32
ROUNDING = 1e-5          # covers the float32 arithmetic on bounds
BLOCK_SCHEMA = "dimension int, rows int, ids binary, codes binary, scales binary, errors binary, vectors binary"


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector): the vectors that take part, one per id."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def code(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(vectors scaled by a power of two, int8 codes, scales, error norms)."""
    _, exponent = np.frexp(np.abs(vectors).max(1))
    vectors = np.ldexp(vectors, -exponent[:, None])
    unit = vectors / np.sqrt((vectors * vectors).sum(1))[:, None]
    scale = np.abs(unit).max(1) / 127.0
    codes = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1))
    return vectors, codes.astype(np.int8), scale, error


def _blocks(size: int):
    def pack(ids, rows):
        vectors, codes, scales, errors = code(np.array(rows))
        return (vectors.shape[1], len(ids), np.array(ids, np.int64).tobytes(), codes.tobytes(), scales.tobytes(),
                errors.tobytes(), vectors.tobytes())

    def run(batches):
        held: dict[int, tuple[list, list]] = {}
        types = [pa.int32(), pa.int32()] + [pa.binary()] * 5
        names = ["dimension", "rows", "ids", "codes", "scales", "errors", "vectors"]
        for b in batches:
            done = []
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids, rows = held.setdefault(len(v), ([], []))
                ids.append(i)
                rows.append(v)
                if len(ids) >= size:
                    done.append(pack(*held.pop(len(v))))
            for x in done:
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(x, types)], names=names)
        for ids, rows in held.values():
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(pack(ids, rows), types)], names=names)

    return run


class Block:
    def __init__(self, dimension, rows, ids, codes, scales, errors, vectors):
        self.ids = np.frombuffer(ids, np.int64)
        self.codes = np.frombuffer(codes, np.int8).reshape(rows, dimension).astype(np.float32)
        self.scales, self.errors = np.frombuffer(scales), np.frombuffer(errors)
        self.vectors = np.frombuffer(vectors).reshape(rows, dimension)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(1))


def code_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of codes (as float64)."""
    out = 0.0
    for k in range(0, a.shape[1], EXACT_DIMENSIONS):
        out = out + (a[:, k:k + EXACT_DIMENSIONS] @ b[:, k:k + EXACT_DIMENSIONS].T).astype(np.float64)
    return out


def tile(queries: Block, candidates: Block, k: int, heaps: list[list]) -> None:
    """Push a tile's survivors on the queries' heaps of (score, -id)."""
    about = code_products(queries.codes, candidates.codes) * queries.scales[:, None] * candidates.scales[None, :]
    bound = (1 + queries.errors)[:, None] * candidates.errors[None, :] + queries.errors[:, None] + ROUNDING
    about[queries.ids[:, None] == candidates.ids[None, :]] = -np.inf
    floor = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps])
    if about.shape[1] >= k:
        floor = np.maximum(floor, np.partition(about - bound, -k, axis=1)[:, -k])
    q, c = np.nonzero((about + bound >= floor[:, None]) & (about > -np.inf))
    score = (queries.vectors[q] * candidates.vectors[c]).sum(1) / (queries.norms[q] * candidates.norms[c])
    for i, s, j in zip(q.tolist(), score.tolist(), (-candidates.ids[c]).tolist()):
        if len(heaps[i]) < k:
            heapq.heappush(heaps[i], (s, j))
        elif (s, j) > heaps[i][0]:
            heapq.heapreplace(heaps[i], (s, j))


def _tiles(k: int):
    def run(batches):
        known: dict[int, tuple[Block, list[list]]] = {}
        for b in batches:
            for number, *row in zip(*(c.to_pylist() for c in b.columns)):
                if number not in known:
                    block = Block(*row[:7])
                    known[number] = block, [[] for _ in block.ids]
                tile(known[number][0], Block(*row[7:]), k, known[number][1])
        for block, heaps in known.values():
            rows = [(q, -j, s) for q, h in zip(block.ids.tolist(), heaps) for s, j in h]
            cols = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64()))],
                names=["query_id", "vec_id", "score"])

    return run


def nearest(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of every query row.
    ``is_query`` is a condition on a column named ``id``."""
    spark = df.sparkSession
    vectors = stored(usable(df, id_col, vector_col), "ann-vectors")
    candidates = stored(vectors.mapInArrow(_blocks(CANDIDATE_BLOCK), BLOCK_SCHEMA), "ann-candidates")
    queries = vectors.where(is_query)
    n, width = queries.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    packed = queries.repartition(max(1, -(-n // QUERY_BLOCK)), "id").mapInArrow(_blocks(QUERY_BLOCK), BLOCK_SCHEMA)
    # numbered by their least id, so that a rerun of a task names them alike
    packed = stored(packed, "ann-queries")
    numbered = packed.withColumn("number", F.xxhash64("ids")).select("number", *packed.columns)
    pairs = candidates.toDF(*[f"c_{c}" for c in candidates.columns])
    parts = max(1, math.ceil(n * (9 * width + 24) / max(BROADCAST_BYTES, 1)))
    parts = min(parts, max(1, -(-n // QUERY_BLOCK)))  # a block is not divided
    found = None
    for part in range(parts):
        some = numbered.where(F.pmod("number", F.lit(parts)) == part)
        tiles = pairs.join(F.broadcast(some), F.col("dimension") == F.col("c_dimension")) \
            .select(*numbered.columns, *pairs.columns).mapInArrow(_tiles(k), "query_id long, vec_id long, score double")
        if parts > 1:
            tiles = stored(tiles, "ann-found")
        found = tiles if found is None else found.unionByName(tiles)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
