"""Chat formatting by minimum-cost role repair.

A conversation is legal if it may begin with one system turn, then alternates
user and assistant turns from a user turn on, and ends with an assistant turn.
A dynamic program over that automaton (state = role of the last output turn)
finds the cheapest way to make a conversation legal: a turn may keep its role,
be relabelled, be merged into the output turn before it when their roles then
agree, and empty turns may be inserted before a turn or at the end.

Of the cheapest repairs the one of least preference counts, summed over its turns:
keeping 0, a merge 1, relabelling to user 4, to assistant 5, to system 6 (so a repair that relabels less
comes first); of those that are still equal the least by a hash of the turns. Costs
are compared with both, so the chosen repair is one and the same however a
conversation is cut and on any number of partitions.

A conversation may be very long, so it is never gathered. Turns without their
texts are sorted over all partitions; a run of turns of one conversation in
one partition acts on the state as a min-plus matrix (4 x 4), computed in a stream.
The matrices of a conversation (at most one per partition) give each run the
state it starts and ends in, and each run is then decoded on its own. Texts are
joined to the decisions once. The result is one row per turn; the pieces
``rendered``, in order of ``position``, are the formatted conversation.

Defined cases: a null text is an empty one; null or unknown roles fit no state
and are relabelled; a null turn number comes last; equal turn numbers are
ordered by role, then by a hash of the text; rows that repeat conversation, turn,
role and text are one turn; a null conversation id is a conversation of its own;
columns other than conv_id, turn, role and text are ignored.
"""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import stored

ROLES = ("system", "user", "assistant")
# state 0: nothing yet; state r: the last output turn has role ROLES[r - 1]
LEGAL_NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = (3,)
COST = {"relabel": 2, "merge": 1, "insert": 3}
FAR = 1 << 60
OPEN, CLOSE, JOIN = "<|im_start|>{role}\n", "<|im_end|>\n", "\n\n"


@lru_cache(maxsize=1)
def insertions() -> list[list[tuple[int, ...] | None]]:
    """Shortest run of inserted roles that leads from one state to another."""
    out: list[list[tuple[int, ...] | None]] = [[None] * 4 for _ in range(4)]
    for s in range(4):
        out[s][s] = ()
        front = [s]
        while front:
            after = []
            for x in front:
                for t in LEGAL_NEXT[x]:
                    if out[s][t] is None:
                        out[s][t] = (*out[s][x], t)
                        after.append(t)
            front = after
    return out


@lru_cache(maxsize=8)
def options(role: int) -> tuple[tuple[int, int, int, bool, tuple[int, ...]], ...]:
    """(from state, to state, cost, merged, inserted) of a turn with that role, the
    cheapest for each pair of states; role 0 is unknown."""
    best: dict[tuple[int, int], tuple] = {}
    for s in range(4):
        for a in range(1, 4):
            base = 0 if a == role else COST["relabel"]
            ways = [(base + COST["merge"], True, ())] if a == s else []
            for t in range(4):
                run = insertions()[s][t]
                if run is not None and a in LEGAL_NEXT[t]:
                    ways.append((base + COST["insert"] * len(run), False, run))
            for cost, merged, run in ways:
                if (s, a) not in best or cost < best[s, a][0]:
                    best[s, a] = cost, merged, run
    return tuple((s, a, *x) for (s, a), x in sorted(best.items()))


# A turn's cost and preference in one number: costs count first.
PREFERENCE = {"keep": 0, "merge": 1, "relabel": {2: 4, 3: 5, 1: 6}}
SHIFT = 32
WEIGHT_BITS = 38


def weights(salt: int) -> np.ndarray:
    """Of the 16 pairs of states, from a turn's hash: the last resort in a tie."""
    with np.errstate(over="ignore"):
        x = (np.arange(16, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(64 - WEIGHT_BITS)).astype(np.int64).reshape(4, 4)


def step_matrix(role: int) -> np.ndarray:
    m = np.full((4, 4), FAR, np.int64)
    for s, a, cost, merged, _ in options(role):
        like = (PREFERENCE["merge"] if merged else 0) + (0 if a == role else PREFERENCE["relabel"][a])
        m[s, a] = (cost << SHIFT) + like
    return m


STEPS = [step_matrix(r) for r in range(4)]
END_COST = np.array([min(COST["insert"] * len(insertions()[s][f]) << SHIFT if insertions()[s][f] is not None else FAR
                         for f in FINAL) for s in range(4)], np.int64)


def step(role: int, salt: int) -> np.ndarray:
    """What a turn costs from state to state, and its weights: a 2 x 4 x 4 array."""
    return np.stack([STEPS[role], weights(salt)])


def least(cost: np.ndarray, weight: np.ndarray, axis: int) -> np.ndarray:
    """The least (cost, weight) along an axis, both compared in that order."""
    low = cost.min(axis, keepdims=True)
    w = np.where(cost == low, weight, np.iinfo(np.int64).max).min(axis)
    low = np.minimum(low.squeeze(axis), FAR)
    return np.stack([low, np.where(low < FAR, w, 0)])


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return least(a[0][:, :, None] + b[0][None, :, :], a[1][:, :, None] + b[1][None, :, :], 1)


def decode(turns: list[tuple[int, int]], start: int, end: int) -> list[int]:
    """States after each (role, hash) of a run on the best way from start to end."""
    cost = np.full(4, FAR, np.int64)
    cost[start] = 0
    weight = np.zeros(4, np.int64)
    back = np.zeros((len(turns), 4), np.int8)
    for k, (role, salt) in enumerate(turns):
        c, w = step(role, salt)
        c, w = cost[:, None] + c, weight[:, None] + w
        best = np.where(c == c.min(0), w, np.iinfo(np.int64).max)
        back[k] = best.argmin(0)
        cost, weight = least(c, w, 0)
    out, s = [], end
    for k in range(len(turns) - 1, -1, -1):
        out.append(s)
        s = int(back[k, s])
    return out[::-1]


def plan_runs(matrices: list[np.ndarray]) -> tuple[list[int], int]:
    """(entry state of every run and the last state, total cost) of a conversation."""
    costs = [np.stack([np.array([0, FAR, FAR, FAR], np.int64), np.zeros(4, np.int64)])]
    for m in matrices:
        c, w = costs[-1]
        costs.append(least(c[:, None] + m[0], w[:, None] + m[1], 0))

    def first(c, w):
        return int(np.where(c == c.min(), w, np.iinfo(np.int64).max).argmin())
    total, weight = costs[-1][0] + END_COST, costs[-1][1]
    last = first(total, weight)
    states = [last]
    for m, (c, w) in zip(matrices[::-1], costs[-2::-1]):
        states.append(first(c + m[0][:, states[-1]], w + m[1][:, states[-1]]))
    return states[::-1], int(total[last] >> SHIFT)


def _number(batches):
    """Place of every turn in its sorted partition."""
    seq = 0
    for b in batches:
        at = pa.array(range(seq, seq + b.num_rows), pa.int64())
        seq += b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, at], names=[*b.schema.names, "seq"])


def _runs(batches):
    """(part, conv_id, turns, matrix) of each run of one conversation in a part."""
    key, matrix, n, out = None, None, 0, []

    def flush():
        cols = list(zip(*out))
        out.clear()
        types = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                          names=["part", "conv_id", "turns", "matrix"])

    for b in batches:
        for part, conv, code, salt in zip(*(b.column(i).to_pylist() for i in range(4))):
            if (part, conv) != key:
                if key is not None:
                    out.append((*key, n, matrix.ravel().tolist()))
                key, matrix, n = (part, conv), step(code, salt), 1
            else:
                matrix, n = min_plus(matrix, step(code, salt)), n + 1
        if out:
            yield flush()
    if key is not None:
        out.append((*key, n, matrix.ravel().tolist()))
        yield flush()


def _plans(batches):
    """Entry, exit and offset of every run, from a conversation's runs in order."""
    for b in batches:
        out = []
        for conv, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            states, cost = plan_runs([np.array(r["matrix"], np.int64).reshape(2, 4, 4) for r in runs])
            offset = 0
            for k, r in enumerate(runs):
                out.append((conv, r["part"], states[k], states[k + 1], offset, k + 1 == len(runs), cost))
                offset += r["turns"]
        cols = list(zip(*out)) or [[]] * 7
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)],
                                         names=["conv_id", "part", "entry", "exit", "offset", "ends", "total_cost"])


DECISION = "conv_id long, turn long, role string, h1 long, h2 long, position long, new_role string, action string, " \
           "cost long, total_cost long, opens string, closes string"


def _decisions(batches):
    """What becomes of every turn of the runs, read in order of part and place."""
    run: list[tuple] = []

    def blank(roles):
        return "".join(OPEN.format(role=ROLES[r - 1]) + CLOSE for r in roles)

    def finish():
        entry, exit_, offset, ends, total = run[0][7:12]
        states = decode([(r[5], r[6]) for r in run], entry, exit_)
        before = entry
        for k, (row, state) in enumerate(zip(run, states)):
            conv, turn, role, h1, h2, code = row[:6]
            _, _, cost, merged, run_in = next(x for x in options(code) if x[0] == before and x[1] == state)
            action = "+".join([*(["insert"] if run_in else []), *(["relabel"] if state != code else []),
                               *(["merge"] if merged else [])]) or "keep"
            opens = JOIN if merged else (CLOSE if before else "") + blank(run_in) + OPEN.format(role=ROLES[state - 1])
            closes, before = "", state
            if ends and k + 1 == len(run):
                tail = min((insertions()[state][f] for f in FINAL if insertions()[state][f] is not None), key=len)
                closes = CLOSE + blank(tail)
                cost += COST["insert"] * len(tail)
                action += "+end" if tail else ""
            yield (conv, turn, role, h1, h2, offset + k, ROLES[state - 1], action, cost, total, opens, closes)

    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(),
             pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [x.split()[0] for x in DECISION.split(", ")]

    def table(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

    key = None
    for b in batches:
        out: list[tuple] = []
        for part, *row in zip(*(c.to_pylist() for c in b.columns)):
            if (part, row[0]) != key and run:
                out.extend(finish())
                run.clear()
            key = part, row[0]
            run.append(tuple(row))
        if out:
            yield table(out)
    if run:
        yield table(list(finish()))


def repair(df: DataFrame) -> DataFrame:
    """conv_id, position, turn, role, new_role, action, cost, total_cost (of the
    conversation) and rendered, one row per turn."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.col("role").cast("string").alias("role"), text.alias("text")) \
        .withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    code = F.coalesce(*[F.when(F.lower(F.trim("role")) == r, F.lit(k + 1)) for k, r in enumerate(ROLES)], F.lit(0))
    identity = ["conv_id", "turn", "role", "h1", "h2"]
    order = ["conv_id", F.col("turn").asc_nulls_last(), "role", "h1", "h2"]
    turns = given.select(*identity).distinct().withColumns({"code": code, "salt": F.xxhash64(*identity)}) \
        .repartitionByRange(*order) \
        .sortWithinPartitions(*order)
    # partitions of a range exchange follow each other, so (part, seq) is the order
    turns = stored(turns.withColumn("part", F.spark_partition_id()).mapInArrow(
        _number, "conv_id long, turn long, role string, h1 long, h2 long, code int, salt long, part int, "
                                                                                  "seq long"), "chat-turns")
    placed = turns.repartition("part").sortWithinPartitions("part", "seq")
    runs = placed.select("part", "conv_id", "code", "salt").mapInArrow(
        _runs, "part int, conv_id long, turns long, matrix array<long>")
    plans = stored(runs.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "turns", "matrix"))).alias("runs"))  # at most one per partition
        .mapInArrow(_plans, "conv_id long, part int, entry int, exit int, offset long, ends boolean, total_cost long"),
        "chat-plans")
    p = plans.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "entry", "exit", "offset", "ends", "total_cost")
    known = turns.join(p, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))) \
        .repartition("part").sortWithinPartitions("part", "seq") \
        .select("part", "conv_id", "turn", "role", "h1", "h2", "code", "salt", "entry", "exit", "offset", "ends", "total_cost")
    made = known.mapInArrow(_decisions, DECISION)
    texts = given.dropDuplicates(identity)
    same = made.select(*[F.col(c).alias(f"_{c}") for c in identity], "position", "new_role", "action", "cost",
                       "total_cost", "opens", "closes")
    match = (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
    for c in identity[:3]:
        match = match & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return texts.join(same, match).select(
        "conv_id", "position", "turn", "role", "new_role", "action", "cost", "total_cost",
        F.concat("opens", "text", "closes").alias("rendered"))
