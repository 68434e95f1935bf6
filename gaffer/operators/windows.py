"""Window operators: ranks within a key, periods ahead, top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                name: str = "rank") -> DataFrame:
    """WIN-3: ``row_number`` within a key; ``order`` must end with a unique
    tie-break so results are deterministic (T14)."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
          name: str = "rank") -> DataFrame:
    """SRT-4: top ``k`` rows per key (planned with a map-side group limit).
    The limit is the feature here: a top-k report."""
    return rank_within(df, keys, order, name).filter(F.col(name) <= k)
