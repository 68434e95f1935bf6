"""Line deduplication by overlapping three-line windows.

Each run of three consecutive lines (blank lines do not count, outer blanks of a
line are ignored) is hashed to 128 bits. A window that occurs before, in order
of (doc_id, text hash, position), is a later occurrence; the lines that
later occurrences cover are merged and removed, blank lines stay. The first
occurrence of every window stays, also against itself: a later window that
overlaps the first one in the same document removes nothing.

Only windows that repeat are joined back; the grouping is a partially aggregated
minimum, so a passage that a third of all documents share is never gathered. Texts
are shuffled once, to meet the positions that go.

Defined cases: a null text counts as empty; documents of fewer than three lines
have no window and stay as they are; a document all of whose lines go has an
empty text; rows that repeat doc_id and text are one document and get one
result; a null doc_id comes before all others; other columns are kept as they
are by ``dedup_lines`` (a column named ``n_lines`` or ``n_removed`` is replaced).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaffer.llm.common import SPACES

WINDOW = 3


def _clean(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES))


def _line_places() -> Column:
    """Indexes of the lines with a word, in order."""
    return F.array_compact(F.transform("_lines", lambda x, i: F.when(_clean(x) != "", i)))


def windows(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, h1, h2): every window of rows(doc_id, _hash, _lines);
    ``at`` counts lines with a word."""
    kept = F.filter(F.transform("_lines", _clean), lambda x: x != "")
    lines = rows.select("doc_id", "_hash", kept.alias("kept")).where(F.size("kept") >= WINDOW)
    lines = lines.select("doc_id", "_hash", F.transform("kept", lambda x: F.xxhash64(x)).alias("a"),
                         F.transform("kept", lambda x: F.xxhash64(F.lit(1), x)).alias("b"))
    runs = F.transform(
        F.sequence(F.lit(0), F.size("a") - WINDOW),
        lambda i: F.struct(i.alias("at"),
                           F.xxhash64(*[F.get("a", i + k) for k in range(WINDOW)]).alias("h1"),
                           F.xxhash64(F.lit(2), *[F.get("b", i + k) for k in range(WINDOW)]).alias("h2")))
    return lines.select("doc_id", "_hash", F.inline(runs))


def later_positions(found: DataFrame) -> DataFrame:
    """doc_id, text_hash, places: sorted starts of the later occurrences."""
    first = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "_hash", "at")).alias("first"),
                                          F.count("*").alias("n")).where("n > 1")
    place = F.struct("doc_id", "_hash", "at")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_hash") == F.col("first._hash"))
    later = found.join(first, ["h1", "h2"]).where(place != F.col("first")) \
        .where(~same | (F.col("at") - F.col("first.at") >= WINDOW))
    return later.groupBy("doc_id", "_hash").agg(F.sort_array(F.collect_set("at")).alias("_places"))


def dedup_lines(df: DataFrame) -> DataFrame:
    """``df`` with its text cut, plus n_lines (lines with a word before) and
    n_removed."""
    given = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    # other columns travel packed, so that their names can't clash with those used here
    rest = F.struct(*[df[c] for c in given if c not in ("doc_id", "text")], F.lit(0).alias("doc_id")).alias("_rest")
    rows = df.select(df["doc_id"], F.coalesce(df["text"].cast("string"), F.lit("")).alias("text"), rest) \
        .withColumn("_hash", F.xxhash64("text"))
    cut = later_positions(windows(rows.select("doc_id", "_hash", F.split("text", "\n", -1).alias("_lines")))) \
        .select(F.col("doc_id").alias("_id"), F.col("_hash").alias("_h"), "_places")
    both = rows.join(cut, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left") \
        .withColumn("_lines", F.split("text", "\n", -1)).withColumn("_at", _line_places())
    gone = F.array_distinct(F.flatten(F.transform("_places", lambda p: F.slice("_at", p + 1, WINDOW))))
    both = both.withColumn("_gone", F.when(F.col("_places").isNotNull(), gone))
    stay = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), "_gone")
    n_lines, n_removed = F.size("_at"), F.coalesce(F.size("_gone"), F.lit(0))
    text = F.when(F.col("_gone").isNull(), F.col("text")).when(n_removed == n_lines, F.lit("")) \
        .otherwise(F.array_join(F.transform("_stay", lambda i: F.get("_lines", i)), "\n"))
    own = {"doc_id": F.col("doc_id"), "text": text.alias("text")}
    return both.withColumn("_stay", F.when(F.col("_gone").isNotNull(), stay)).select(
        *[own[c] if c in own else F.col("_rest").getField(c).alias(c) for c in given],
        n_lines.cast("long").alias("n_lines"), n_removed.cast("long").alias("n_removed"))


#: DuckDB SQL for the query of this operator.
ORACLE_SQL = r"""
with lines as (
  select doc_id, coalesce(text, '') as text, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as n
  from documents),
worded as (
  select doc_id, n, trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as w from lines),
placed as (
  select doc_id, n, w, row_number() over (partition by doc_id order by n) as pos from worded where w <> ''),
runs as (
  select doc_id, pos, w as a, lead(w) over d as b, lead(w, 2) over d as c from placed
  window d as (partition by doc_id order by pos)),
marked as (
  select *, first_value(doc_id) over o as first_doc, first_value(pos) over o as first_at from runs where c is not null
  window o as (partition by a, b, c order by doc_id, pos)),
later as (
  select doc_id, pos from marked
  where (doc_id, pos) <> (first_doc, first_at) and (doc_id <> first_doc or pos - first_at >= 3)),
gone as (
  select distinct p.doc_id, p.n from placed p, (select doc_id, unnest([pos, pos + 1, pos + 2]) as pos from later) l
  where p.doc_id = l.doc_id and p.pos = l.pos),
kept as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.n) as text, count(*) as n
  from lines l anti join gone g on l.doc_id = g.doc_id and l.n = g.n group by l.doc_id),
counts as (select doc_id, count(*) as n_lines from placed group by doc_id),
removed as (select doc_id, count(*) as n_removed from gone group by doc_id)
select d.doc_id, coalesce(c.n_lines, 0)::bigint as n_lines, coalesce(r.n_removed, 0)::bigint as n_removed,
       sha256(case when r.n_removed = c.n_lines then '' else coalesce(k.text, '') end) as text_sha256
from documents d left join counts c using (doc_id) left join removed r using (doc_id) left join kept k using (doc_id)
"""
