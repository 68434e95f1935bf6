"""Mixing sources to target weights by a low-discrepancy source schedule.

Only DataFrame functions; texts are read once, for their word count, and are
never shuffled. ``schedule_mix`` gives the mix itself (slots, each a run of
pieces of documents), ``document_takes`` what the mix takes of every document.

* Every source's documents are put in a seeded hash order, read twice in a
  row, and cut into blocks of ``block_words`` words (the last block stops at
  the source's target). A block therefore holds consecutive pieces of shuffled
  documents, and nothing is taken more than twice.
* Slot k of the mix gets the point frac(k * golden ratio), which the cumulative
  target weights map to a source. The r-th slot of a source takes the source's
  r-th block. A source's share of any run of slots is within O(log n / n) of its
  weight. The few slots that a source is short of at the end are appended, and
  surplus ones left out, so every source takes its target exactly, to a word.

Prefix sums and ranks per source are taken in two levels (buckets, then rows
in a bucket), as one source may hold a third of the rows.

Defined cases: a null or blank text has size 0, is kept with ``taken`` 0; a null
source is a source of its own, last in order; rows that repeat a doc_id are
separate rows of the stream, each with its own takes; an empty table gives no
rows; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaffer.llm.common import WORD_REGEX, stored

WEIGHTS = (3, 1, 2)
MIX_SHARE = 1.5   # of all words
MAX_EPOCHS = 2
BLOCK_WORDS = 512
BUCKET_ROWS = 4096  # rows aimed at in one bucket of the two-level sums
TASK_SLOTS = 1 << 18  # slots made by one task
CELL_SLOTS = 64     # least width of the cells in which points look for their source
MOST_CELLS = 4096   # cells of the whole range: with their sources they are no more than this and the sources
GOLDEN = 0.6180339887498949
SEED = 7


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_REGEX)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = MIX_SHARE,
                   epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_no, source_size, n_docs, weight, target.

    Sources by code point, null last, take ``weights`` in turn. Targets share
    ``share`` of all words by weight and stop at ``epochs`` times the source; what
    is cut off is reshared by weight among the others until none is above. That
    level is found in closed form: in order of size / weight the saturated
    sources are a prefix, so one running sum gives the level after each.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    per = per.withColumn("source_no", F.row_number().over(order) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.col("source_no") % len(weights) + 1).cast("int")))
    full = (F.col("source_size") * epochs).cast("double")
    by_ratio = Window.orderBy(full / F.col("weight"), "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything) * F.lit(share)
    # the level if exactly the sources before this one are saturated
    level = (total - F.coalesce(F.sum(full).over(before), F.lit(0.0))) / \
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("level", level).withColumn("free", F.col("level") * F.col("weight") <= full)
    # the first source that is not saturated sets the level for all from it on
    first = F.min(F.when(F.col("free"), F.struct(full / F.col("weight"), F.col("source_no"), F.col("level")))) \
        .over(everything)["level"]
    return per.withColumn("target", F.least(full, F.coalesce(first * F.col("weight"), full))) \
        .select("source", "source_no", "source_size", "n_docs", "weight", "target")


def _streams(sizes: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Documents with words: begin of each in its source's shuffled stream."""
    t = targets.select("source", "source_no", "source_size", "n_docs", "target")
    rows = sizes.join(t, sizes["source"].eqNullSafe(t["source"])).drop(t["source"]).where("size > 0")
    # with the text, so that the rows of one repeated or of no doc_id spread as well
    rows = rows.withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("spread")))
    buckets = F.floor(F.col("n_docs") / BUCKET_ROWS) + 1
    rows = rows.withColumn("bucket", F.pmod(F.col("h"), buckets))
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("bucket_words"))
    ahead = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source_no", "bucket", F.coalesce(F.sum("bucket_words").over(ahead), F.lit(0)).alias("base"))
    inside = Window.partitionBy("source_no", "bucket").orderBy("h", "doc_id", "size", "spread") \
        .rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("in_bucket", F.coalesce(F.sum("size").over(inside), F.lit(0))) \
        .join(sums, ["source_no", "bucket"]) \
        .withColumn("begin", F.col("base") + F.col("in_bucket")) \
        .select("doc_id", "source_no", "size", "begin", "source_size", "target")


def _blocks(streams: DataFrame, block_words: int, epochs: int) -> DataFrame:
    """Pieces of documents in the equal-word blocks of their source."""
    quota = F.floor(F.col("target") + 0.5).cast("long")
    copies = streams.withColumn("epoch", F.explode(F.array(*[F.lit(e) for e in range(epochs)]))) \
        .withColumn("first", F.col("begin") + F.col("epoch") * F.col("source_size")) \
        .withColumn("last", F.least(F.col("first") + F.col("size"), quota)) \
        .where("first < last")
    spans = copies.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("first") / block_words), F.floor((F.col("last") - 1) / block_words))))
    start = F.greatest(F.col("first"), F.col("block") * block_words)
    stop = F.least(F.col("last"), (F.col("block") + 1) * block_words)
    return spans.select("doc_id", "source_no", "begin", "epoch", "block", "size",
                        (start - F.col("first")).alias("from_word"), (stop - F.col("first")).alias("to_word"))


def source_schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """Slots of the mix: slot, source_no, block (the source's slots ranked)."""
    need = targets.select("source_no", F.ceil(F.floor(F.col("target") + 0.5) / block_words).alias("slots")) \
        .where("slots > 0")
    bounds = need.withColumn("total", F.sum("slots").over(Window.partitionBy())) \
        .withColumn("hi", F.sum("slots").over(Window.orderBy("source_no"))) \
        .withColumn("lo", F.col("hi") - F.col("slots"))
    spark = targets.sparkSession
    total = bounds.agg(F.max("total")).first()[0] or 0
    # a range: Spark knows its size, as it would not know that of an exploded sequence
    slots = spark.range(0, total, 1, total // TASK_SLOTS + 1).select(
        F.floor(F.col("id") / BUCKET_ROWS).alias("run"), F.col("id").alias("slot"))
    point = F.col("slot") * F.lit(GOLDEN)
    slots = slots.withColumn("at", (point - F.floor(point)) * F.lit(total))
    # points find their source's range [lo, hi) through cells of equal width
    width = max(CELL_SLOTS, -(-total // MOST_CELLS))
    cells = bounds.select("source_no", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("cell"))
    slots = slots.withColumn("cell", F.floor(F.col("at") / width)).join(cells, "cell") \
        .where("lo <= at and at < hi").select("run", "slot", "source_no")
    per_run = slots.groupBy("source_no", "run").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("source_no").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    base = per_run.withColumn("base", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    rank = Window.partitionBy("source_no", "run").orderBy("slot")
    ranked = slots.withColumn("r", F.row_number().over(rank) - 1).join(base, ["source_no", "run"]) \
        .withColumn("block", F.col("base") + F.col("r"))
    kept = ranked.join(need, "source_no").where("block < slots").select("slot", "source_no", "block")
    have = base.groupBy("source_no").agg(F.sum("n").alias("have"))
    short = bounds.join(have, "source_no", "left").withColumn("have", F.coalesce("have", F.lit(0))) \
        .where("have < slots").select(
            "source_no", "total", "lo", F.explode(F.sequence(F.col("have"), F.col("slots") - 1)).alias("block"))
    late = short.select((F.col("total") + F.col("lo") + F.col("block")).alias("slot"), "source_no", "block")
    return kept.unionByName(late)


def document_sizes(df: DataFrame) -> DataFrame:
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                     word_count(F.col("text").cast("string")).alias("size"),
                     F.xxhash64(F.col("text").cast("string")).alias("spread"))


def schedule_mix(df: DataFrame, weights=WEIGHTS, share: float = MIX_SHARE, epochs: int = MAX_EPOCHS,
                 block_words: int = BLOCK_WORDS, seed: int = SEED):
    """(sizes, targets, streams, pieces). ``pieces`` is the mix: slot, source_no,
    block, doc_id, epoch, from_word, to_word and the document's place ``begin``."""
    sizes = stored(document_sizes(df), "mix-sizes")
    targets = stored(source_targets(sizes, weights, share, epochs), "mix-targets")
    streams = stored(_streams(sizes, targets, seed), "mix-streams")
    # both sides grow with the input, and an exploded one is larger than Spark can tell: neither may be broadcast
    slots = source_schedule(targets, block_words).hint("merge")
    return sizes, targets, streams, slots.join(_blocks(streams, block_words, epochs), ["source_no", "block"])


def document_takes(df: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken: one row per row of ``df``."""
    sizes, targets, streams, pieces = schedule_mix(df, **options)
    place = ["source_no", "doc_id", "begin", "size"]
    taken = pieces.groupBy(*place).agg(F.sum(F.col("to_word") - F.col("from_word")).alias("taken"))
    # documents that no slot reaches come in with nothing taken
    rows = streams.select(*place, F.lit(0).cast("long").alias("taken")).unionByName(taken)
    used = rows.groupBy(*place).agg(F.sum("taken").alias("taken"))
    blank = sizes.where("size = 0").join(targets, sizes["source"].eqNullSafe(targets["source"])).select(
        "source_no", "doc_id", "size", F.lit(0).cast("long").alias("taken"))
    return used.drop("begin").unionByName(blank).join(targets, "source_no").select(
        "doc_id", "source", "size", "source_size", "target", "taken")


def mixed_documents(df: DataFrame, **options) -> DataFrame:
    """The mix as documents: every row of ``df`` as often as the mix takes it.

    The slots of a source run through its stream without gaps, so all but the last
    document of a stream are taken whole; that one comes along if at least half of
    it is taken. Rows alike in doc_id, source and size share their takes evenly.
    """
    takes = document_takes(df, **options).where("taken > 0").groupBy("doc_id", "source", "size").agg(
        F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias("_copies")).where("_copies > 0") \
        .toDF("_id", "_source", "_size", "_copies")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("_row"))  # names inside can't clash
    doc = F.col("_row")
    same = doc["doc_id"].cast("long").eqNullSafe(F.col("_id")) & doc["source"].cast("string").eqNullSafe(F.col("_source")) \
        & (word_count(doc["text"].cast("string")) == F.col("_size"))
    return rows.join(takes, same).select("_row", F.explode(F.sequence(F.lit(1), "_copies"))).select("_row.*")
