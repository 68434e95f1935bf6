"""Set operations between current and historical entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def union_current_historical(current: DataFrame, historical: DataFrame) -> DataFrame:
    """SET-1: ``union all`` by column name (the reference is positional; we
    require the same names and cast the historical side to the current types)."""
    cast = historical.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                for f in current.schema.fields])
    return current.unionByName(cast)


def transfer_diff(before: DataFrame, after: DataFrame, keys: Sequence[str],
                  item: str, pair_by: str | None = None, order: str | None = None) -> DataFrame:
    """SET-2 / DEC-12: items leaving and joining each key's set, paired by
    position within ``pair_by`` (e.g. playing position) in ``order``."""
    outs = before.join(after.select(*keys, item), [*keys, item], "left_anti")
    ins = after.join(before.select(*keys, item), [*keys, item], "left_anti")
    if pair_by is None:
        return (outs.withColumn("direction", F.lit("out"))
                .unionByName(ins.withColumn("direction", F.lit("in"))))
    part = [*keys, pair_by]
    o = F.col(order).desc() if order else F.col(item)
    w = Window.partitionBy(*part).orderBy(o, F.col(item))
    outs = outs.withColumn("pair", F.row_number().over(w)).select(
        *part, "pair", F.col(item).alias(f"{item}_out"))
    ins = ins.withColumn("pair", F.row_number().over(w)).select(
        *part, "pair", F.col(item).alias(f"{item}_in"))
    return outs.join(ins, [*part, "pair"], "full")
