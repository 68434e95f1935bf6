"""Seed reference tables (SRC-4): scoring rules and squad rules.

Small literal tables, bounded by construction (4 positions, 8 formations),
so they are safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Scoring rules per position (must equal the reference seed).
# position_id, position_name, goal_points, assist_points, clean_sheet_points,
# points_per_60_min_start, points_per_short_appearance,
# goals_conceded_penalty_per_2, yellow_card_points, red_card_points,
# own_goal_points, penalty_miss_points, penalty_save_points, save_points_per_3
SCORING_RULES = [
    (1, "Goalkeeper", 6, 3, 4, 2, 1, -1, -1, -3, -2, -2, 5, 1),
    (2, "Defender", 6, 3, 4, 2, 1, -1, -1, -3, -2, -2, 5, 1),
    (3, "Midfielder", 5, 3, 1, 2, 1, 0, -1, -3, -2, -2, 5, 1),
    (4, "Forward", 4, 3, 0, 2, 1, 0, -1, -3, -2, -2, 5, 1),
]
SCORING_COLUMNS = [
    "position_id", "position_name", "goal_points", "assist_points", "clean_sheet_points",
    "points_per_60_min_start", "points_per_short_appearance", "goals_conceded_penalty_per_2",
    "yellow_card_points", "red_card_points", "own_goal_points", "penalty_miss_points",
    "penalty_save_points", "save_points_per_3",
]

# Squad rules (per position: squad quota, XI minimum, XI maximum).
SQUAD_RULES = [(1, 2, 1, 1), (2, 5, 3, 5), (3, 5, 2, 5), (4, 3, 1, 3)]
MAX_PER_CLUB = 3
SQUAD_SIZE = 15
XI_SIZE = 11
DEFAULT_BUDGET_TENTHS = 1000


def scoring_rules_schema() -> T.StructType:
    fields = [T.StructField("position_id", T.IntegerType(), False),
              T.StructField("position_name", T.StringType(), False)]
    fields += [T.StructField(c, T.IntegerType(), False) for c in SCORING_COLUMNS[2:]]
    return T.StructType(fields)


def scoring_rules(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The scoring seed: from a CSV file with a header (typed by schema, no
    inference) or, without a path, the literal rows above."""
    if path:
        return spark.read.csv(path, header=True, schema=scoring_rules_schema())
    return spark.createDataFrame(SCORING_RULES, scoring_rules_schema())


def squad_quotas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(p, q) for p, q, _, _ in SQUAD_RULES], "position_id int, squad_quota int")


def formation_shapes() -> list[tuple[int, int, int]]:
    """(DEF, MID, FWD) starters of the legal formations, from the squad rules."""
    (_, _, d0, d1), (_, _, m0, m1), (_, _, f0, f1) = SQUAD_RULES[1:]
    return [(d, m, f) for d in range(d0, d1 + 1) for m in range(m0, m1 + 1) for f in range(f0, f1 + 1)
            if 1 + d + m + f == XI_SIZE]


def formations(spark: SparkSession) -> DataFrame:
    """The legal starting formations (1 GK; DEF 3-5, MID 2-5, FWD 1-3; 11
    players), one row per (formation, position, starters)."""
    rows = []
    for fid, (d, m, f) in enumerate(formation_shapes(), 1):
        name = f"{d}-{m}-{f}"
        rows += [(fid, name, 1, 1), (fid, name, 2, d), (fid, name, 3, m), (fid, name, 4, f)]
    return spark.createDataFrame(rows, "formation_id int, formation string, position_id int, starters int")
