"""Latest-record operators over append-only snapshot tables.

``latest_per_key`` is the workhorse: ``row_number() == 1`` over a window keyed
by the entity. Catalyst plans it as a map-side ``WindowGroupLimit`` before the
shuffle, so a hot key (one entity holding a third of all rows) is reduced to
one row per map task before it ever reaches a single reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _orders(order: Sequence) -> list[Column]:
    """Order spec: names mean *descending*, NULLs last; Columns are used as is."""
    out = []
    for o in order:
        out.append(F.col(o).desc_nulls_last() if isinstance(o, str) else o)
    return out


def latest(df: DataFrame, order: Sequence) -> DataFrame:
    """SEL-1: the single newest row overall (``order by … desc limit 1``).
    Planned as ``TakeOrderedAndProject``: each task keeps its top row, the
    driver merges one row per task."""
    return df.orderBy(*_orders(order)).limit(1)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence,
                   rank_col: str | None = None) -> DataFrame:
    """SEL-2/3 (``distinct on``): newest row per key.

    ``order`` must end with a tie-break that is unique within a key (T1);
    NULL keys form their own group, as ``distinct on`` does.
    """
    w = Window.partitionBy(*keys).orderBy(*_orders(order))
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1)
    return out if rank_col else out.drop(rn)


def historical_only(hist: DataFrame, current: DataFrame, key: str,
                    order: Sequence) -> DataFrame:
    """SEL-4: newest historical row of every entity that is absent from the
    current set (``not exists`` -> left anti join; NULL keys dropped)."""
    present = current.select(key).where(F.col(key).isNotNull())
    cand = hist.where(F.col(key).isNotNull()).join(present, key, "left_anti")
    return latest_per_key(cand, [key], order)


def latest_run(df: DataFrame, ts: str) -> DataFrame:
    """SEL-5: all rows of the latest run (``ts = (select max(ts))``).
    The max is a one-row global aggregate, so broadcasting it is bounded."""
    mx = df.agg(F.max(ts).alias("__max_ts"))
    return (df.join(F.broadcast(mx), F.col(ts) == F.col("__max_ts"), "inner")
              .drop("__max_ts"))


def newest_run(df: DataFrame, keys: Sequence[str], order: Sequence[str], few: bool = False) -> DataFrame:
    """SEL-1/2 for payloads landed in several rows or cells: ALL rows of each
    key's newest run, i.e. with the key's greatest ``order`` values (e.g.
    ``fetched_at, run_id``). Without keys: of the newest run overall.

    The maximum is a partially aggregated group (one row per key and task is
    shuffled) joined back; a hot key's rows are never gathered in one task, as
    adaptive execution splits a skewed side of that join. ``few``: the keys are a
    handful by construction (seasons). Hashed by them all rows would sit in as
    many tasks, none of them skewed; their newest runs are broadcast instead.
    """
    stamp = F.struct(*[F.col(c).alias(c) for c in order])
    top = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(stamp).alias("__top"))
    same = stamp.eqNullSafe(F.col("__top"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    if few or not keys:
        top = F.broadcast(top)  # one row per key, or of a global aggregate
    return df.join(top, same).select(*df.columns)


def latest_period(df: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """SEL-6: rows of each entity's latest period (all tied rows kept)."""
    w = Window.partitionBy(*keys).orderBy(F.col(period).desc())
    return (df.withColumn("__rk", F.rank().over(w))
              .filter(F.col("__rk") == 1).drop("__rk"))


def last_event(events: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """SEL-7: last matching event per (entity, item); use with a left join.

    The reference sorts a nullable timestamp ``desc`` in PostgreSQL, where
    NULLs come first (T2): pass ``F.col(ts).desc_nulls_first()`` to keep that.
    """
    return latest_per_key(events, keys, order)


def snapshot_changes(df: DataFrame, keys: Sequence[str], ts: str,
                     cols: Sequence[str], tiebreak: str | None = None, chunk: Column | None = None) -> DataFrame:
    """SEL-8: change of each column since the entity's previous snapshot.

    An entity may hold a large part of all rows, so its history is cut into chunks
    of time (``chunk``, a column that grows with ``ts``; by default ranges of equal numbers
    of rows, see :mod:`gaffer.operators.validity`) that are ordered apart. A chunk's first row takes the values before it from the
    chunks' last rows, of which each entity has one per chunk.
    """
    order = [F.col(ts)] + ([F.col(tiebreak)] if tiebreak else [])
    if chunk is None:
        from gaffer.operators.validity import PIECE, in_pieces
        columns = df.columns
        pieces = in_pieces(df, keys, [ts] + ([tiebreak] if tiebreak else []))
        return snapshot_changes(pieces, keys, ts, cols, tiebreak, F.col(PIECE)).select(
            *columns, *[f"{kind}_{c}" for c in cols for kind in ("prev", "delta")])
    rows = df.withColumn("__chunk", chunk)
    values = F.struct(*[F.col(c).alias(c) for c in cols])
    inside = Window.partitionBy(*keys, "__chunk").orderBy(*order)
    rows = rows.withColumn("__first", F.row_number().over(inside) == 1).withColumn("__lag", F.lag(values).over(inside))
    # the greatest order is the chunk's last row; NULLs come first in both
    last = df.withColumn("__chunk", chunk).groupBy(
        *[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__chunk").alias("__c")).agg(
        F.max_by(values, F.struct(*order)).alias("__last"))
    over_chunks = Window.partitionBy(*[f"__k_{k}" for k in keys]).orderBy("__c")
    before = last.withColumn("__before", F.lag("__last").over(over_chunks)).drop("__last")
    same = F.col("__chunk").eqNullSafe(F.col("__c"))
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    out = rows.join(before, same)
    prev = F.when(F.col("__first"), F.col("__before")).otherwise(F.col("__lag"))
    out = out.withColumn("__prev", prev)
    extra = []
    for c in cols:
        extra += [F.col("__prev")[c].alias(f"prev_{c}"), (F.col(c) - F.col("__prev")[c]).alias(f"delta_{c}")]
    return out.select(*df.columns, *extra)
