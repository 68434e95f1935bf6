"""Validity intervals of snapshots and as-of joins to them (SEL-8).

An entity may hold a large part of all rows, so its history is never one window: rows are
dealt out by range of (entity, time), which cuts a long history into pieces of equal numbers of
rows, windows run within a piece, and what a piece takes from the pieces before or after it comes
from one row per entity and piece.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaffer.sources.landing import materialized

PIECE = "__piece"


def in_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` with the number of its piece; pieces follow each other in the order of
    (keys, order), nulls first. Stored, as another run may cut other pieces."""
    columns = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    return materialized(df.repartitionByRange(*columns).withColumn(PIECE, F.spark_partition_id()), "pieces")


def _same(keys: Sequence[str], *more: str) -> Column:
    out = F.lit(True)
    for k in [*keys, *more]:
        out = out & F.col(k).eqNullSafe(F.col(f"__of_{k}"))
    return out


def _named(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(f"__of_{c}") if c in (*keys, PIECE) else F.col(c) for c in df.columns])


def validity_intervals(df: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
                       tiebreak: str | None = None) -> DataFrame:
    """keys, cols, valid_from, valid_to: runs of snapshots with equal ``cols``, collapsed.

    ``valid_from`` is the first snapshot's time, ``valid_to`` the next run's first time, null
    for the run that still holds. Snapshots of one time follow each other by ``tiebreak``; a run that is
    replaced at its own time is empty (valid_from = valid_to). A null time comes before all
    others; equal means null-safe equal."""
    order = [ts] + ([tiebreak] if tiebreak else [])
    values = F.struct(*[F.col(c).alias(c) for c in cols])
    rows = in_pieces(df.select(*dict.fromkeys([*keys, *order, *cols])), keys, order)
    sort = [F.col(c).asc_nulls_first() for c in order]
    inside = Window.partitionBy(*keys, PIECE).orderBy(*sort)
    # an array tells "no snapshot before" from one of nulls
    rows = rows.withColumn("__lag", F.lag(F.array(values)).over(inside))
    last = rows.groupBy(*keys, PIECE).agg(F.max_by(F.array(values), F.struct(*order)).alias("__last"))
    pieces = Window.partitionBy(*keys).orderBy(PIECE)
    before = _named(last.withColumn("__before", F.lag("__last").over(pieces)).drop("__last"), keys)
    known = rows.join(before, _same(keys, PIECE)).withColumn("__prev", F.coalesce("__lag", "__before"))
    starts = known.where(~F.col("__prev").eqNullSafe(F.array(values))).select(*rows.columns)
    following = F.lead(F.struct(ts)).over(inside)
    starts = starts.drop("__lag").withColumn("__next", following)
    # the last run of a piece ends where the next piece that starts one does so
    first = starts.groupBy(*keys, PIECE).agg(F.min_by(F.struct(ts), F.struct(*order)).alias("__start"))
    after = _named(first.withColumn("__after", F.lead("__start").over(pieces)).drop("__start"), keys)
    out = starts.join(after, _same(keys, PIECE))
    return out.select(*keys, *cols, F.col(ts).alias("valid_from"), F.coalesce("__next", "__after")[ts].alias("valid_to"))


def as_of(facts: DataFrame, intervals: DataFrame, keys: Sequence[str], ts: str, cols: Sequence[str],
          since: str = "valid_from") -> DataFrame:
    """``facts`` with the ``cols`` that held for their keys at ``ts`` (the newest interval that
    starts at or before it), null where there is none, and ``since``.

    Facts and starts of intervals are one sorted sequence; no fact meets more than the
    interval it needs, however many its entity has."""
    # of intervals that start at one time all but the one that lasted are empty
    state = intervals.where(F.col("valid_to").isNull() | ~F.col("valid_to").eqNullSafe(F.col("valid_from"))).select(
        *keys, F.col("valid_from").alias("__ts"), F.lit(0).alias("__kind"),
        F.struct(*[F.col(c).alias(c) for c in cols], F.col("valid_from").alias(since)).alias("__state"))
    rows = facts.select(*keys, F.col(ts).alias("__ts"), F.lit(1).alias("__kind"), F.struct(*facts.columns).alias("__fact"))
    both = in_pieces(state.unionByName(rows, allowMissingColumns=True), keys, ["__ts", "__kind"])
    inside = Window.partitionBy(*keys, PIECE).orderBy(F.col("__ts").asc_nulls_first(), "__kind") \
        .rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("__here", F.last("__state", ignorenulls=True).over(inside))
    last = both.groupBy(*keys, PIECE).agg(F.max_by("__state", F.when(F.col("__kind") == 0, F.struct(
        F.col("__ts").isNotNull(), "__ts"))).alias("__last"))
    pieces = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    before = _named(last.withColumn("__before", F.last("__last", ignorenulls=True).over(pieces)).drop("__last"), keys)
    found = both.where("__kind = 1").join(before, _same(keys, PIECE)).withColumn("__found", F.coalesce("__here", "__before"))
    return found.select("__fact.*", *[F.col("__found")[c].alias(c) for c in cols], F.col("__found")[since].alias(since))
