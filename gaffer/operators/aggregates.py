"""Weighted group rates: a hash aggregate with a map-side partial step, so a hot
group is combined before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.functions.scalars import default, safe_div


def group_baseline(df: DataFrame, group: Sequence[str], rates: Sequence[str],
                   weight: str) -> DataFrame:
    """AGG-3 / FRM-5: ``sum(coalesce(rate,0) * w) / nullif(sum(w), 0)`` per group."""
    aggs = [safe_div(F.sum(default(r, 0) * F.col(weight)), F.sum(weight)).alias(r) for r in rates]
    return df.groupBy(*group).agg(*aggs)
