"""Rate, shrinkage and expected-points formulas as Column expressions.

These are the analytical core of the forecast: recency weights, per-90 rates,
shrinkage toward a group baseline, availability, expected minutes, fixture
multipliers and the per-fixture points expression. Each is a pure Column
builder so the same expression serves the single-period and multi-period
forecasts.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from gaffer.functions.scalars import _c, decay, default, safe_div

# Fixed values (model parameters of the reference forecast).
RECENCY_DECAY = 0.55          # weight per season back
CONFIDENCE_PRIOR = 10.0       # weighted periods that equal the prior's trust
FULL_MATCH_MINUTES = 90       # minutes of a start
SUB_APPEARANCE_MINUTES = 15   # minutes assumed for a non-start
HORIZON_DISCOUNT = 0.95       # per period ahead
DEFAULT_HORIZON = 8           # periods in the horizon
FREE_TRANSFER_HIT = 4         # points charged per transfer beyond the free ones

# Measures turned into per-90 rates (numerator column -> output rate name).
PER90_MEASURES = [
    ("total_points", "points_per_90"),
    ("goals_scored", "goals_per_90"),
    ("assists", "assists_per_90"),
    ("goals_conceded", "goals_conceded_per_90"),
    ("own_goals", "own_goals_per_90"),
    ("penalties_missed", "penalties_missed_per_90"),
    ("penalties_saved", "penalties_saved_per_90"),
    ("yellow_cards", "yellow_cards_per_90"),
    ("red_cards", "red_cards_per_90"),
    ("saves", "saves_per_90"),
    ("bonus", "bonus_per_90"),
]

# Rates that are shrunk toward the group baseline (order of the outputs).
SHRUNK_RATES = [
    "start_rate", "goals_per_90", "assists_per_90", "clean_sheet_rate_per_start",
    "goals_conceded_per_90", "own_goals_per_90", "penalties_missed_per_90",
    "penalties_saved_per_90", "yellow_cards_per_90", "red_cards_per_90",
    "saves_per_90", "bonus_per_90",
]


def seasons_back(current_year, row_year) -> Column:
    return _c(current_year) - _c(row_year)


def recency_weight(n_back, base: float = RECENCY_DECAY) -> Column:
    """``base ** max(n_back, 0)``."""
    return decay(base, F.greatest(_c(n_back), F.lit(0)))


def per_90(weighted_measure, weighted_minutes) -> Column:
    return safe_div(weighted_measure, weighted_minutes) * F.lit(90)


def confidence(total_weight, prior: float = CONFIDENCE_PRIOR) -> Column:
    """``coalesce(w, 0) / prior``, exact when ``w`` is a decimal."""
    return default(total_weight, 0) * F.lit(Decimal(1) / Decimal(str(prior)))


def shrink(rate, baseline, conf) -> Column:
    """``(c * coalesce(rate, 0) + baseline) / (c + 1)``."""
    c = _c(conf)
    return (c * default(rate, 0) + _c(baseline)) / (c + F.lit(1.0))


def availability(status, chance) -> Column:
    """Status ``'a'`` -> chance or 100%, otherwise chance or 0%."""
    return (F.when(_c(status) == F.lit("a"), default(chance, 100))
            .otherwise(default(chance, 0)) / F.lit(100.0))


def expected_minutes(avail, start_rate) -> Column:
    sr = _c(start_rate)
    return _c(avail) * (sr * F.lit(FULL_MATCH_MINUTES)
                        + (F.lit(1) - sr) * F.lit(SUB_APPEARANCE_MINUTES))


def attack_multiplier(is_home, avg_def_home, avg_def_away, opp_def_home, opp_def_away) -> Column:
    """League-average defence over the opponent's defence at the venue the
    opponent plays (away when the player is at home)."""
    return F.when(_c(is_home), safe_div(avg_def_away, opp_def_away)) \
        .otherwise(safe_div(avg_def_home, opp_def_home))


def defence_multiplier(is_home, avg_att_home, avg_att_away, opp_att_home, opp_att_away) -> Column:
    return F.when(_c(is_home), safe_div(avg_att_away, opp_att_away)) \
        .otherwise(safe_div(avg_att_home, opp_att_home))


def fixture_points(has_fixture="fixture_id", minutes="expected_minutes",
                   att="attack_multiplier", dfn="defence_multiplier",
                   avail="availability_factor") -> Column:
    """Expected points of one fixture from shrunk rates and scoring rules.

    Expects the rate columns of :data:`SHRUNK_RATES` and the scoring-rule
    columns on the row. A row without a fixture scores 0; a NULL multiplier
    (unknown opponent strength) makes the fixture NULL, as the reference does.
    """
    m = _c(minutes) / F.lit(90.0)
    a, d = _c(att), _c(dfn)
    pts = (
        m * F.col("points_per_60_min_start")
        + m * F.col("goals_per_90") * a * F.col("goal_points")
        + m * F.col("assists_per_90") * a * F.col("assist_points")
        + _c(avail) * F.col("start_rate") * F.col("clean_sheet_rate_per_start") * d
        * F.col("clean_sheet_points")
        + m * safe_div("goals_conceded_per_90", d) / F.lit(2.0) * F.col("goals_conceded_penalty_per_2")
        + m * F.col("bonus_per_90")
        + m * F.col("yellow_cards_per_90") * F.col("yellow_card_points")
        + m * F.col("red_cards_per_90") * F.col("red_card_points")
        + m * F.col("own_goals_per_90") * F.col("own_goal_points")
        + m * F.col("penalties_missed_per_90") * F.col("penalty_miss_points")
        + m * F.col("penalties_saved_per_90") * F.col("penalty_save_points")
        + m * F.col("saves_per_90") / F.lit(3.0) * F.col("save_points_per_3")
    )
    return F.when(_c(has_fixture).isNull(), F.lit(0.0)).otherwise(pts)


def horizon_discount(weeks_ahead, base: float = HORIZON_DISCOUNT) -> Column:
    return decay(base, weeks_ahead)
