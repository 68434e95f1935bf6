"""Conformed dimensions across id spaces (MRT-1, MRT-2, MRT-4, INT-1).

Season-specific ids are resolved to stable codes before any cross-season
join; current entities win over historical ones on a code overlap, and
historical-only entities keep their most recent season's attributes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaffer.functions.scalars import first_of, typed_null, zero_to_null
from gaffer.operators.joins import with_scalar_row
from gaffer.operators.setops import union_current_historical
from gaffer.operators.snapshots import historical_only, latest_per_key

STRENGTH_COLS = [
    "strength", "strength_overall_home", "strength_overall_away",
    "strength_attack_home", "strength_attack_away",
    "strength_defence_home", "strength_defence_away",
]


def dim_teams(current: DataFrame, historical: DataFrame) -> DataFrame:
    """MRT-2: current teams (zero strength = unpublished -> most recent
    historical rating -> average of every club's most recent rating) unioned
    with historical-only teams.

    ``current``: team_code, team_id, team_name, team_short_name, strengths,
    league_position, points. ``historical``: season, team_code, team_name,
    team_short_name, strengths.
    """
    cur = current.select(
        "team_code", F.col("team_id").alias("current_team_id"), "team_name", "team_short_name",
        *[zero_to_null(c).alias(c) for c in STRENGTH_COLS],
        "league_position", "points", F.lit(True).alias("is_in_current_season"))
    # SEL-3: NULL team_code forms its own group and enters the average (T12)
    recent = latest_per_key(historical, ["team_code"], [F.col("season").desc()]) \
        .select("team_code", *STRENGTH_COLS)
    avg = recent.agg(*[F.avg(c).alias(f"__a_{c}") for c in STRENGTH_COLS])
    h = recent.select("team_code", *[F.col(c).alias(f"__h_{c}") for c in STRENGTH_COLS])
    filled = with_scalar_row(cur.join(h, "team_code", "left"), avg).select(
        "team_code", "current_team_id", "team_name", "team_short_name",
        *[first_of(c, f"__h_{c}", f"__a_{c}").cast("double").alias(c) for c in STRENGTH_COLS],
        "league_position", "points", "is_in_current_season")
    hist_only = historical_only(historical, current.select("team_code"), "team_code",
                                [F.col("season").desc()]).select(
        "team_code", typed_null("int").alias("current_team_id"), "team_name", "team_short_name",
        *[F.col(c).cast("double").alias(c) for c in STRENGTH_COLS],
        typed_null("int").alias("league_position"), typed_null("int").alias("points"),
        F.lit(False).alias("is_in_current_season"))
    return union_current_historical(filled, hist_only)


def dim_players(players: DataFrame, teams: DataFrame, historical: DataFrame,
                current_cols: dict[str, str], hist_cols: dict[str, str]) -> DataFrame:
    """MRT-1: current players (team id resolved to team code) unioned with
    historical-only players (newest season per code).

    ``current_cols``/``hist_cols`` map output column -> source column; an
    output missing from ``hist_cols`` becomes a typed NULL.
    """
    p = players.join(teams.select("team_id", F.col("team_code").alias("current_team_code")),
                     "team_id", "left")
    cur = p.select(*[F.col(src).alias(out) for out, src in current_cols.items()],
                   F.lit(True).alias("is_in_current_season"))
    types = {f.name: f.dataType for f in cur.schema.fields}
    ho = historical_only(historical, players.select("player_code"), "player_code",
                         [F.col("season").desc()])
    hist = ho.select(*[(F.col(hist_cols[o]) if o in hist_cols else typed_null(types[o])).alias(o)
                       for o in current_cols],
                     F.lit(False).alias("is_in_current_season"))
    return union_current_historical(cur, hist)


def dim_gameweeks(current: DataFrame, historical_stats: DataFrame, season: str) -> DataFrame:
    """MRT-4: the current season calendar with flags and scores, plus every
    distinct historical (season, period) seen in the stats, finished by definition."""
    cur = current.select(F.lit(season).alias("season"), "gameweek_id", "gameweek_name", "deadline_time",
                         "is_finished", "is_current", "is_next", "average_entry_score", "highest_score")
    hist = historical_stats.where(F.col("gameweek_id").isNotNull()) \
        .select("season", "gameweek_id").distinct().select(
            "season", "gameweek_id",
            F.concat(F.lit("Gameweek "), F.col("gameweek_id").cast("string")).alias("gameweek_name"),
            typed_null("timestamp").alias("deadline_time"),
            F.lit(True).alias("is_finished"), F.lit(False).alias("is_current"),
            F.lit(False).alias("is_next"), typed_null("int").alias("average_entry_score"),
            typed_null("int").alias("highest_score"))
    return union_current_historical(cur, hist)
