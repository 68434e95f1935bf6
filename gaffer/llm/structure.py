"""Conversation structure repair by weighted CYK interval parsing.

A conversation's turns, in order, are edited until the initials of their roles match
``(s?(ua)+)?``. Edits: Keep (0), Rerole to user or assistant (2), Delete (3) and
Insert an empty user or assistant turn anywhere (2). A turn has at most one fault: blank
(no character but spaces), duplicate (its role and text are seen earlier) or truncated (its
last character is not one of ``.!?``). Blank and duplicate turns must be deleted, a truncated
one that stays costs 1. Of the cheapest repairs the one whose edits' initials, in order, are
least in ASCII counts.

The repair grammar is in Chomsky normal form. Its nonterminals are the pairs (p, q) of
states of the role order that some turns lead through; its rules are (p, q) -> (p, r) (r, q).
A turn derives the pairs that its edits allow, and the insertion closure puts the cheapest
insertions, which cover no turn, on both sides. A cell of the chart is the least (cost, audit)
of a nonterminal over a span of turns; spans are combined bottom-up by their length. Audits of one
cell and cost have equal numbers of edits, so none is a beginning of another and the least of
a concatenation is the concatenation of the least.

The rules cover every place to split a span, so a long conversation needs no chart
over all its spans: spans of up to ``BLOCK`` turns have a chart, whose top cells are the
leaves of the chart of the next ``BLOCK`` spans, and so on. A conversation may be very
long and is never gathered: its turns, without texts, are sorted over all partitions, each partition's run is
parsed in a stream, the runs' top cells (one set per partition) are combined, and
each run is edited on its own by its part of the audit. Only the audit itself and the digest, a
hash of one text, are made one conversation after the other.

Defined cases: nulls in role and text are one space; a null conversation id is a conversation
of its own; turns are ordered by number, nulls first, then by role, then by text (its first
64 characters, then its hash); rows that repeat conversation, turn, role and text are adjacent and
all but one of them are duplicates; an empty table gives an empty result; columns other than
conv_id, turn, role and text are ignored.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import SPACES, stored

# states: 0 nothing yet, 1 a system turn, 2 a user turn, 3 an assistant turn came last
MOVES = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FINAL = (0, 3)
ROLE_OF = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
PAIRS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
AT = {pair: k for k, pair in enumerate(PAIRS)}
RULES = [(AT[p, r], AT[r, q], AT[p, q]) for p, r in PAIRS for r2, q in PAIRS if r == r2]
BLOCK = 8
CACHED_BLOCKS = 20_000
PREFIX = 64

Cell = tuple[int, str]
Cells = list[Cell | None]


def combine(left: Cells, right: Cells, into: Cells) -> None:
    """Improve the cells of a span by those of its two parts."""
    for a, b, c in RULES:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            cost, old = x[0] + y[0], into[c]
            if old is None or cost < old[0] or (cost == old[0] and x[1] + y[1] < old[1]):
                into[c] = cost, x[1] + y[1]


def chart(leaves: list[Cells]) -> Cells:
    """Cells of the whole span: CYK, bottom-up by span length."""
    span = {(i, 1): cells for i, cells in enumerate(leaves)}
    for length in range(2, len(leaves) + 1):
        for i in range(len(leaves) - length + 1):
            cells: Cells = [None] * len(PAIRS)
            for k in range(1, length):
                combine(span[i, k], span[i + k, length - k], cells)
            span[i, length] = cells
    return span[0, len(leaves)]


@lru_cache(maxsize=1)
def closure() -> Cells:
    """Cheapest insertions alone, for each pair of states."""
    cells: Cells = [None] * len(PAIRS)
    for p in range(4):
        front, cost = {p}, 0
        while front:
            for q in front:
                if cells[AT[p, q]] is None:
                    cells[AT[p, q]] = INSERT * cost, "I" * cost
            cost += 1
            front = {MOVES[s, r] for s in front for r in "ua" if (s, r) in MOVES}
            front = {q for q in front if cells[AT[p, q]] is None}
    return cells


@lru_cache(maxsize=64)
def leaf(initial: str, must_go: bool, truncated: bool) -> tuple[Cell | None, ...]:
    """Cells of one turn, closed under insertions on both sides."""
    cells: Cells = [None] * len(PAIRS)

    def offer(p, q, cost, audit):
        if cells[AT[p, q]] is None or (cost, audit) < cells[AT[p, q]]:
            cells[AT[p, q]] = cost, audit
    for p in range(4):
        offer(p, p, DELETE, "D")
        if not must_go:
            extra = TRUNCATED if truncated else 0
            if (p, initial) in MOVES:
                offer(p, MOVES[p, initial], KEEP + extra, "K")
            for role in "ua":
                if (p, role) in MOVES:
                    offer(p, MOVES[p, role], REROLE + extra, "R")
    return tuple(chart([closure(), cells, closure()]))


@lru_cache(maxsize=CACHED_BLOCKS)
def block(turns: tuple[tuple[str, bool, bool], ...]) -> tuple[Cell | None, ...]:
    """Cells of up to BLOCK turns; equal blocks are parsed once in a worker."""
    return tuple(chart([leaf(*t) for t in turns]))


class Parser:
    """Cells of a run of any length, taken turn by turn: a level holds fewer than
    BLOCK finished spans, each BLOCK times as long as those of the level below."""

    def __init__(self):
        self.turns: list[tuple[str, bool, bool]] = []
        self.levels: list[list[Cells]] = []

    def add(self, initial: str, must_go: bool, truncated: bool) -> None:
        self.turns.append((initial, must_go, truncated))
        if len(self.turns) < BLOCK:
            return
        cells, level = block(tuple(self.turns)), 0
        self.turns.clear()
        while cells is not None:
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(cells)
            cells = None
            if len(self.levels[level]) == BLOCK:
                cells = chart(self.levels[level])
                self.levels[level] = []
                level += 1

    def cells(self) -> Cells:
        """Of all turns so far; short spans at the end are combined first."""
        rest = [block(tuple(self.turns))] if self.turns else []
        for level in self.levels:
            rest = [chart([*level, *rest])] if level or rest else []
        return rest[0] if rest else closure()


def join_runs(runs: list[Cells]) -> tuple[int, list[tuple[int, str]]]:
    """(cost, [(state that the run begins in, its part of the audit)]) of the runs
    that make up a conversation."""
    # least (cost, audit) of all runs so far by the state reached, with the states passed
    best: dict[int, tuple[int, str, tuple[int, ...]]] = {0: (0, "", (0,))}
    for cells in runs:
        after: dict[int, tuple[int, str, tuple[int, ...]]] = {}
        for (p, q), cell in zip(PAIRS, cells):
            if cell is not None and p in best:
                cost, audit, path = best[p]
                new = cost + cell[0], audit + cell[1], (*path, q)
                if q not in after or new < after[q]:
                    after[q] = new
        best = after
    cost, _, path = min(best[q] for q in FINAL if q in best)
    return cost, [(p, cells[AT[p, q]][1]) for p, q, cells in zip(path, path[1:], runs)]


def edit(audit: str, state: int, initials: list[str]):
    """(edit, turn number or None, new role or None) along an audit."""
    at = 0
    for letter in audit:
        if letter == "D":
            yield letter, at, None
            at += 1
            continue
        role = initials[at] if letter == "K" else "a" if state == 2 else "u"
        state = MOVES[state, role]
        yield letter, None if letter == "I" else at, None if letter == "K" else ROLE_OF[role]
        at += letter != "I"


def _number(batches):
    """Place of every turn in its sorted partition."""
    seq = 0
    for b in batches:
        at = pa.array(range(seq, seq + b.num_rows), pa.int64())
        seq += b.num_rows
        yield pa.RecordBatch.from_arrays([*b.columns, at], names=[*b.schema.names, "seq"])


RUN = "part int, conv_id long, start long, copies long, first string, last string, illegal long, blank long, duplicate long, " \
      "truncated long, numbers long, least long, most long, cells array<struct<cost:long,audit:string>>"
CELLS = pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())]))
RUN_TYPES = [pa.int32(), *[pa.int64()] * 3, pa.string(), pa.string(), *[pa.int64()] * 7, CELLS]


def _names(schema: str) -> list[str]:
    depth, out, word = 0, [], ""
    for c in schema + ",":
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(word.split()[0])
            word = ""
        else:
            word += c
    return out


def _table(rows, schema, types):
    cols = list(zip(*rows)) or [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names=_names(schema))


class Run:
    """What a stream of one conversation's turns in one partition amounts to."""

    def __init__(self, part, conv, start):
        self.key, self.start, self.parser = (part, conv), start, Parser()
        self.copies = self.illegal = self.numbers = 0
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.first = self.last = self.least = self.most = None

    def add(self, turn, initial, fault, copies):
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.illegal += copies - 1  # equal initials side by side
        self.copies += copies
        if fault:
            self.faults[fault] += 1
        # a copy of a blank turn is blank
        self.faults["blank" if fault == "blank" else "duplicate"] += copies - 1
        if turn is not None:
            self.numbers += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        self.parser.add(initial, fault in ("blank", "duplicate"), fault == "truncated")
        for _ in range(copies - 1):
            self.parser.add(initial, True, False)

    def row(self):
        cells = [None if c is None else {"cost": c[0], "audit": c[1]} for c in self.parser.cells()]
        return (*self.key, self.start, self.copies, self.first, self.last, self.illegal, *self.faults.values(), self.numbers,
                self.least, self.most, cells)


def _runs(batches):
    run = None
    for b in batches:
        out = []
        for part, conv, seq, turn, initial, fault, copies in zip(*(c.to_pylist() for c in b.columns)):
            if run is None or run.key != (part, conv):
                if run is not None:
                    out.append(run.row())
                run = Run(part, conv, seq)
            run.add(turn, initial, fault, copies)
        if out:
            yield _table(out, RUN, RUN_TYPES)
    if run is not None:
        yield _table([run.row()], RUN, RUN_TYPES)


PLAN = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, " \
       "runs array<struct<part:int,start:long,state:int,offset:long,audit:string>>"
PLAN_TYPES = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.struct(
    [("part", pa.int32()), ("start", pa.int64()), ("state", pa.int32()), ("offset", pa.int64()), ("audit", pa.string())]))]


def _plans(batches):
    """A conversation's figures and audit from its runs in order."""
    for b in batches:
        out = []
        for conv, runs in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            cost, parts = join_runs([[None if c is None else (c["cost"], c["audit"]) for c in r["cells"]] for r in runs])
            illegal = sum(r["illegal"] for r in runs) + sum(
                x["last"] + y["first"] not in ("su", "ua", "au") for x, y in zip(runs, runs[1:]))
            known = [r for r in runs if r["least"] is not None]
            numbers = sum(r["numbers"] for r in known) - sum(x["most"] == y["least"] for x, y in zip(known, known[1:]))
            gaps = known[-1]["most"] - known[0]["least"] + 1 - numbers if known else 0
            plans, offset = [], 0
            for r, (state, audit) in zip(runs, parts):
                plans.append({"part": r["part"], "start": r["start"], "state": state, "offset": offset, "audit": audit})
                offset += len(audit) - audit.count("D")
            out.append((conv, gaps, *(sum(r[c] for r in runs) for c in ("blank", "duplicate", "truncated")), illegal, cost,
                        "".join(a for _, a in parts), plans))
        yield _table(out, PLAN, PLAN_TYPES)


EDIT = "conv_id long, position long, edit string, turn long, role string, h1 long, h2 long, new_role string"
EDIT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]


def _edits(batches):
    """The turns that stay or are inserted. A run's plan comes right before its turns."""
    plan, run = None, []

    def finish():
        conv, state, offset, audit = plan
        rows = [r for r in run for _ in range(r[4])]
        for letter, at, role in edit(audit, state, [r[1][:1] for r in rows]):
            if letter == "I":
                yield conv, offset, letter, None, None, None, None, role
            elif letter != "D":
                turn, old, h1, h2 = rows[at][:4]
                yield conv, offset, letter, turn, old, h1, h2, role or old
            offset += letter != "D"

    for b in batches:
        out: list[tuple] = []
        for is_turn, conv, *row in zip(*(c.to_pylist() for c in b.columns)):
            if is_turn:
                run.append(row)
            else:
                if plan is not None:
                    out.extend(finish())
                run, plan = [], (conv, *row[5:])
        yield _table(out, EDIT, EDIT_TYPES)
    if plan is not None:
        yield _table(list(finish()), EDIT, EDIT_TYPES)


IDENTITY = ["conv_id", "turn", "role", "h1", "h2"]


def _same(pairs) -> Column:
    out = F.lit(True)
    for a, b in pairs:
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def repair(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns). Conversations: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit. Turns, the repaired ones: conv_id, position, edit (K, R or I),
    turn, role, new_role, text."""
    space = F.lit(" ")
    given = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.coalesce(F.col("role").cast("string"), space).alias("role"),
                      F.coalesce(F.col("text").cast("string"), space).alias("text")) \
        .withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})
    words = F.btrim("text", F.lit(SPACES))
    # blank and truncated hang on the text alone, so equal texts agree
    slim = given.select(*IDENTITY, F.substring("text", 1, PREFIX).alias("prefix"), (words == "").alias("is_blank"),
                        (~F.right(words, F.lit(1)).isin(".", "!", "?")).alias("is_cut")) \
        .groupBy(*IDENTITY, "prefix", "is_blank", "is_cut").agg(F.count("*").alias("copies"))
    slim = stored(slim, "cyk-turns")
    # texts that a role says at several turns: all but the first are duplicates
    again = slim.groupBy("conv_id", "role", "h1", "h2") \
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")).alias("first"), F.count("*").alias("n")) \
        .where("n > 1").toDF("_conv_id", "_role", "_h1", "_h2", "first", "n")
    found = slim.join(again, _same([(c, f"_{c}") for c in ("conv_id", "role", "h1", "h2")]), "left")
    later = F.col("n").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = F.when(F.col("is_blank"), "blank").when(later, "duplicate").when(F.col("is_cut"), "truncated")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "prefix", "h1", "h2"]
    sorted_ = found.select("conv_id", "turn", "role", "prefix", "h1", "h2", "copies", fault.alias("fault")) \
        .repartitionByRange(*order).sortWithinPartitions(*order)
    # partitions of a range exchange follow each other, so (part, seq) is the order
    columns = "conv_id long, turn long, role string, h1 long, h2 long, copies long, fault string, part int, seq long"
    turns = stored(sorted_.drop("prefix").withColumn("part", F.spark_partition_id()).mapInArrow(_number, columns), "cyk-order")
    placed = turns.withColumn("initial", F.substring("role", 1, 1)).repartition("part").sortWithinPartitions("part", "seq")
    runs = placed.select("part", "conv_id", "seq", "turn", "initial", "fault", "copies").mapInArrow(_runs, RUN)
    plans = stored(runs.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct(*[c for c in _names(RUN) if c != "conv_id"]))).alias("runs"))  # at most one per partition
        .mapInArrow(_plans, PLAN), "cyk-plans")
    # one stream per partition: each run's plan, then its turns
    plan = plans.select("conv_id", F.inline("runs")).withColumnRenamed("start", "seq").withColumn("is_turn", F.lit(False))
    stream = turns.withColumn("is_turn", F.lit(True)).unionByName(plan, allowMissingColumns=True) \
        .repartition("part").sortWithinPartitions("part", "seq", "is_turn") \
        .select("is_turn", "conv_id", "turn", "role", "h1", "h2", "copies", "state", "offset", "audit")
    edits = stored(stream.mapInArrow(_edits, EDIT), "cyk-edits")
    kept = edits.where("edit <> 'I'").toDF(*[f"_{c}" if c in IDENTITY else c for c in edits.columns])
    texts = given.dropDuplicates(IDENTITY)
    out = ["conv_id", "position", "edit", "turn", "role", "new_role", "text"]
    kept = texts.join(kept, _same([(c, f"_{c}") for c in IDENTITY])).select(*out)
    inserted = edits.where("edit = 'I'").withColumn("text", F.lit("")).select(*out)
    return plans.drop("runs"), kept.unionByName(inserted)


def _digests(batches):
    key, digest, out = None, None, []
    for b in batches:
        for conv, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if digest is None or conv != key:
                if digest is not None:
                    out.append((key, digest.hexdigest()))
                key, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(piece.encode())
        if out:
            yield _table(out, "conv_id long, digest string", [pa.int64(), pa.string()])
            out.clear()
    if digest is not None:
        yield _table([(key, digest.hexdigest())], "conv_id long, digest string", [pa.int64(), pa.string()])


def digests(turns: DataFrame) -> DataFrame:
    """conv_id, digest: SHA-256 of the repaired turns as ``role:text``, one a line. A hash is
    taken in order, so a conversation is read in a stream by one task, never held."""
    lines = turns.select("conv_id", F.concat("new_role", F.lit(":"), "text").alias("line"), "position")
    return lines.repartition("conv_id").sortWithinPartitions("conv_id", "position").select("conv_id", "line") \
        .mapInArrow(_digests, "conv_id long, digest string")


def damage(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults that a checksum of ``conv_id:turn`` picks
    (nulls read as one space): 0 drops the row, 1 empties the text, 2 removes its full stops,
    exclamation and question marks, 3 repeats the row, 4 makes it the user's."""
    space = F.lit(" ")
    rows = df.select("conv_id", "turn", *[F.coalesce(F.col(c).cast("string"), space).alias(c) for c in ("role", "text")])
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    rows = rows.withColumn("pick", F.crc32(name.cast("binary")) % 20).where("pick <> 0")
    text = F.when(F.col("pick") == 1, "").when(F.col("pick") == 2, F.regexp_replace("text", "[.!?]", "")) \
        .otherwise(F.col("text"))
    role = F.when(F.col("pick") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("pick") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("copy")).drop("copy")


def damaged_and_repaired(conversations: DataFrame) -> DataFrame:
    """Every conversation, damaged and repaired, with the digest of the result."""
    figures, turns = repair(damage(conversations))
    known = figures.join(digests(turns).withColumnRenamed("conv_id", "_conv_id"),
                         F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").drop("_conv_id")
    ids = conversations.select(F.col("conv_id").cast("long").alias("_conv_id")).distinct()
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return ids.join(known, F.col("conv_id").eqNullSafe(F.col("_conv_id")), "left").select(
        F.col("_conv_id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))


# Dynamic programming over turns and states in place of spans; the audit is then
# walked letter by letter.
ORACLE_SQL = """
WITH RECURSIVE
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
                   lambda c: ascii(c)::BIGINT) AS bytes
  FROM conversations),
picked AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda h, b:
    list_reduce(list_prepend(xor(h, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y:
      xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT) % 20 AS pick
  FROM named),
damaged AS (
  SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN pick = 1 THEN '' WHEN pick = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM picked, range(CASE pick WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS solid
  FROM damaged),
faults AS (
  SELECT *, CASE WHEN solid = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                 WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS adjacent
  FROM placed),
figures AS (
  SELECT conv_id, max(k) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (adjacent NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id),
moves(p, letter, q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
-- what may be inserted before a turn or at the end: up to two turns
filled(p, q, cost, audit) AS (
  SELECT p, p, 0, '' FROM range(4) t(p)
  UNION ALL SELECT p, q, 2, 'I' FROM moves WHERE letter <> 's'
  UNION ALL SELECT a.p, b.q, 4, 'II' FROM moves a JOIN moves b ON a.q = b.p WHERE a.letter <> 's' AND b.letter <> 's'),
edits AS (
  SELECT f.conv_id, f.k, p.p, p.p AS q, 3 AS cost, 'D' AS audit FROM faults f, range(4) p(p)
  UNION ALL
  SELECT f.conv_id, f.k, m.p, m.q, (f.fault = 'truncated')::INT + CASE WHEN m.letter = f.initial THEN 0 ELSE 2 END,
    CASE WHEN m.letter = f.initial THEN 'K' ELSE 'R' END
  FROM faults f JOIN moves m ON m.letter = f.initial OR m.letter <> 's' WHERE f.fault NOT IN ('blank', 'duplicate')),
steps AS (
  SELECT e.conv_id, e.k, a.p, e.q, a.cost + e.cost AS cost, a.audit || e.audit AS audit
  FROM edits e JOIN filled a ON a.q = e.p),
paths AS (
  SELECT conv_id, 0::BIGINT AS k, 0::BIGINT AS state, '000000' AS best FROM figures
  UNION ALL
  SELECT w.conv_id, w.k + 1, s.q::BIGINT, min(printf('%06d', left(w.best, 6)::INT + s.cost) || substr(w.best, 7) || s.audit)
  FROM paths w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.k = w.k + 1 AND s.p = w.state
  GROUP BY w.conv_id, w.k, s.q),
solved AS (
  SELECT f.conv_id, min(printf('%06d', left(w.best, 6)::INT + e.cost) || substr(w.best, 7) || e.audit) AS best
  FROM figures f JOIN paths w ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.k = f.n
  JOIN filled e ON e.p = w.state AND e.q IN (0, 3) GROUP BY f.conv_id),
walk AS (
  SELECT conv_id, substr(best, 7) AS audit, 0::BIGINT AS i, 0::BIGINT AS k, 0::BIGINT AS state, ''::VARCHAR AS role, NULL::BIGINT AS text_of
  FROM solved
  UNION ALL
  SELECT w.conv_id, w.audit, w.i + 1, w.k + (letter <> 'I')::BIGINT,
    CASE WHEN letter = 'D' THEN w.state WHEN letter = 'K' AND f.initial = 's' THEN 1 WHEN w.state = 2 THEN 3 ELSE 2 END::BIGINT,
    CASE WHEN letter = 'K' THEN f.role WHEN w.state = 2 THEN 'assistant' ELSE 'user' END,
    CASE WHEN letter IN ('K', 'R') THEN w.k + 1 WHEN letter = 'I' THEN 0 END
  FROM (SELECT *, substr(audit, i + 1, 1) AS letter FROM walk WHERE i < length(audit)) w
  LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.k + 1),
repaired AS (
  SELECT w.conv_id, string_agg(w.role || ':' || coalesce(f.text, ''), chr(10) ORDER BY w.i) AS text
  FROM walk w LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.k = w.text_of
  WHERE w.text_of IS NOT NULL GROUP BY w.conv_id)
SELECT c.conv_id, coalesce(f.gaps, 0) AS gaps, coalesce(f.blank, 0) AS blank, coalesce(f.duplicate, 0) AS duplicate,
  coalesce(f.truncated, 0) AS truncated, coalesce(f.illegal, 0) AS illegal,
  coalesce(left(s.best, 6)::BIGINT, 0) AS cost, coalesce(substr(s.best, 7), '') AS audit,
  sha256(coalesce(r.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN solved s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""
