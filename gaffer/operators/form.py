"""Recency-weighted form, group baseline and shrinkage (FRM-1..7, INT-2..4).

Grain in/out:
* ``recent_form``: performance rows (entity x fixture) -> one row per entity.
  One hash aggregate keyed by the entity (partial aggregation map-side).
* ``group_baseline_rates``: entity rates -> one row per group (a handful of
  rows: positions), used through a broadcast join.
* ``shrunk_form``: current entities with rates pulled toward the baseline.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.functions.formulas import (
    PER90_MEASURES, SHRUNK_RATES, availability, confidence, per_90,
    recency_weight, shrink,
)
from gaffer.functions.scalars import default, safe_div, season_year
from gaffer.operators.aggregates import group_baseline


def recent_form(perf: DataFrame, current_season: str, key: str = "player_code",
                season: str = "season", starts_known_only: bool = False) -> DataFrame:
    """INT-2: recency-weighted per-90 rates per entity.

    ``w = 0.55 ** max(year(current) - year(season), 0)``; rates are weighted
    sums over weighted minutes x 90; start rate over the weight; clean sheets
    per weighted start. A NULL ``starts`` still counts in the weight (T7, as
    the reference does); ``starts_known_only`` divides the start rate by the
    weight of rows whose ``starts`` is known instead.
    """
    back = (F.lit(int(current_season[:4])) - season_year(season)).alias("seasons_back")
    measures = ["minutes", "starts", "clean_sheets"] + [m for m, _ in PER90_MEASURES]
    base = perf.select(F.col(key), back, *[F.col(m) for m in measures])
    # exact decimal weights (0.55 ** k has at most 2k digits) so the weighted
    # sums do not depend on the order of addition across tasks
    w = recency_weight("seasons_back").cast("decimal(20,12)")
    # A weight is at most 1, so that its 12 digits are two integers of 6; counts are summed with
    # each of them as longs and put together once per entity, to the same decimal.
    base = base.withColumn("__w", w).withColumn("__units", (F.col("__w") * F.lit(10 ** 12)).cast("bigint"))
    w, parts = F.col("__w"), (F.expr("__units div 1000000"), F.expr("__units % 1000000"))
    counts = {f.name for f in base.schema.fields if f.dataType.typeName() in ("byte", "short", "integer")}

    def weighted(m):
        if m not in counts:
            return F.sum(F.col(m) * w)
        hi, lo = (F.sum(F.col(m) * part).cast("decimal(19,0)") for part in parts)
        return hi * F.lit(Decimal("0.000001")) + lo * F.lit(Decimal("0.000000000001"))
    agg = base.groupBy(key).agg(
        F.sum(w).alias("total_weight"),
        F.sum(F.when(F.col("starts").isNotNull(), w)).alias("__known_w"),
        F.count(F.lit(1)).alias("gameweek_rows"),
        F.bool_or((F.col("seasons_back") == 0) & (F.col("minutes") > 0)).alias("has_current_season_minutes"),
        *[weighted(m).alias(f"weighted_{m}") for m in measures],
    )
    def d(c):
        return F.col(c).cast("double")
    rates = [
        safe_div(d("weighted_starts"), d("__known_w" if starts_known_only else "total_weight"))
        .alias("start_rate"),
        safe_div(d("weighted_clean_sheets"), d("weighted_starts")).alias("clean_sheet_rate_per_start"),
    ] + [per_90(d(f"weighted_{m}"), d("weighted_minutes")).alias(out) for m, out in PER90_MEASURES]
    return agg.select(key, "total_weight", "gameweek_rows", "has_current_season_minutes", *rates)


def group_baseline_rates(form: DataFrame, dim: DataFrame, key: str = "player_code",
                         group: str = "position_id") -> DataFrame:
    """INT-3: per-group rates weighted by each entity's total weight, over all
    entities of the dimension (departed ones included)."""
    joined = form.join(dim.select(key, group), key, "inner")
    return group_baseline(joined, [group], SHRUNK_RATES, "total_weight")


def shrunk_form(dim: DataFrame, form: DataFrame, baseline: DataFrame,
                key: str = "player_code", group: str = "position_id",
                current_flag: str = "is_in_current_season",
                carry=("web_name", "current_team_code", "current_price", "status",
                       "chance_of_playing_next_round")) -> DataFrame:
    """INT-4: one row per current entity, each rate shrunk toward its group's
    baseline in proportion to its recency-weighted sample size."""
    cur = dim.where(F.col(current_flag))
    f = form.select(key, "total_weight", *[F.col(r).alias(f"__r_{r}") for r in SHRUNK_RATES])
    b = baseline.select(group, *[F.col(r).alias(f"__b_{r}") for r in SHRUNK_RATES])
    # the baseline has one row per group: bounded, broadcast
    j = cur.join(f, key, "left").join(F.broadcast(b), group, "inner")
    conf = confidence("total_weight")
    return j.select(
        key, *carry, group,
        availability("status", "chance_of_playing_next_round").alias("availability_factor"),
        conf.alias("confidence_weight"),
        *[shrink(f"__r_{r}", f"__b_{r}", conf).alias(r) for r in SHRUNK_RATES],
    )
