"""Fixture-aware expected points (FRC-1..6, MRT-7, MRT-11..13).

Plan shape at scale: the entity table (shrunk form, keyed by entity) is
crossed with a bounded, broadcast period list (at most ``horizon`` rows),
equi-joined to the exploded fixture list (two rows per fixture, keyed by
(period, team) -- the reference's OR join rewritten), enriched with the
opponent's strengths, the one-row league averages and the scoring rules (all
bounded), then aggregated per (entity, period). The entity side is never
re-shuffled for the dimension joins, and the final aggregate reuses the
entity partitioning when the input came out of an entity-keyed join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaffer.functions.formulas import (
    DEFAULT_HORIZON, attack_multiplier, defence_multiplier, expected_minutes,
    fixture_points, horizon_discount,
)
from gaffer.operators.joins import bounded, entity_fixtures


def target_periods(gameweeks: DataFrame, season: str, horizon: int,
                   period: str = "gameweek_id", next_flag: str = "is_next") -> DataFrame:
    """FLT-4 + WIN-1 + SRT-3: the first ``horizon`` periods of the season
    starting at the one flagged next (the smallest such period, T3), with
    ``weeks_ahead`` = 0, 1, ... . No period flagged next -> no rows (T4)."""
    cal = gameweeks.where(F.col("season") == F.lit(season)).select(period, next_flag)
    start = cal.where(F.col(next_flag)).agg(F.min(period).alias("__start"))
    w = Window.partitionBy(F.lit(season)).orderBy(F.col(period))
    return (cal.join(bounded(start), F.col(period) >= F.col("__start"), "inner")
               .select(period)
               .withColumn("weeks_ahead", (F.row_number().over(w) - 1).cast("int"))
               .where(F.col("weeks_ahead") < horizon))


def league_strength(teams: DataFrame, current_flag: str = "is_in_current_season") -> DataFrame:
    """AGG-5: one-row average strengths of the current teams."""
    return teams.where(F.col(current_flag)).agg(
        F.avg("strength_attack_home").alias("avg_attack_home"),
        F.avg("strength_attack_away").alias("avg_attack_away"),
        F.avg("strength_defence_home").alias("avg_defence_home"),
        F.avg("strength_defence_away").alias("avg_defence_away"),
    )


def _fixture_rows(fixtures: DataFrame) -> DataFrame:
    return entity_fixtures(fixtures, "fixture_id", "home_team_code", "away_team_code",
                           extra=["gameweek_id"])


def expected_points_by_period(shrunk: DataFrame, periods: DataFrame, fixtures: DataFrame,
                              teams: DataFrame, rules: DataFrame,
                              carry=("web_name", "position_id", "current_team_code",
                                     "current_price")) -> DataFrame:
    """MRT-12: expected points per (entity, period) over the target periods.

    A blank period gives one row with ``fixture_count`` 0 and 0 points; a
    double period sums its fixtures. A fixture against an opponent with
    unknown strength counts in ``fixture_count`` but adds nothing (T6).
    """
    grid = shrunk.crossJoin(bounded(periods))
    fx = _fixture_rows(fixtures).select(
        F.col("gameweek_id").alias("__gw"), F.col("team").alias("__team"),
        "fixture_id", F.col("opponent").alias("opponent_team_code"), "is_home")
    rows = grid.join(fx, (F.col("gameweek_id") == F.col("__gw"))
                     & (F.col("current_team_code") == F.col("__team")), "left") \
        .drop("__gw", "__team")
    opp = teams.select(
        F.col("team_code").alias("opponent_team_code"),
        F.col("strength_attack_home").alias("__o_ah"), F.col("strength_attack_away").alias("__o_aa"),
        F.col("strength_defence_home").alias("__o_dh"), F.col("strength_defence_away").alias("__o_da"))
    rows = rows.join(opp, "opponent_team_code", "left") \
        .crossJoin(bounded(league_strength(teams))) \
        .join(bounded(rules), "position_id", "left")
    has_rules = F.col("goal_points").isNotNull()
    xmin = expected_minutes("availability_factor", "start_rate")
    att = attack_multiplier("is_home", "avg_defence_home", "avg_defence_away", "__o_dh", "__o_da")
    dfn = defence_multiplier("is_home", "avg_attack_home", "avg_attack_away", "__o_ah", "__o_aa")
    scored = rows.select(
        "player_code", *carry, "gameweek_id", "weeks_ahead",
        F.when(has_rules, F.col("fixture_id")).alias("fixture_id"),
        F.when(has_rules, fixture_points("fixture_id", xmin, att, dfn, "availability_factor"))
         .alias("points"))
    return scored.groupBy("player_code", "gameweek_id", "weeks_ahead").agg(
        *[F.first(c).alias(c) for c in carry],
        F.count("fixture_id").alias("fixture_count"),
        F.coalesce(F.sum("points"), F.lit(0.0)).alias("expected_points"),
    )


def expected_points_next(shrunk: DataFrame, gameweeks: DataFrame, fixtures: DataFrame,
                         teams: DataFrame, rules: DataFrame, season: str) -> DataFrame:
    """MRT-11: the next period only, with availability and confidence columns."""
    periods = target_periods(gameweeks, season, 1)
    carry = ("web_name", "position_id", "current_team_code", "current_price", "status",
             "chance_of_playing_next_round", "confidence_weight")
    return expected_points_by_period(shrunk, periods, fixtures, teams, rules, carry=carry) \
        .drop("weeks_ahead")


def expected_points_horizon(by_period: DataFrame,
                            carry=("web_name", "position_id", "current_team_code",
                                   "current_price")) -> DataFrame:
    """MRT-13 / FRC-5: discounted sum over the horizon per entity."""
    return by_period.groupBy("player_code").agg(
        *[F.first(c).alias(c) for c in carry],
        F.sum(F.col("expected_points") * horizon_discount("weeks_ahead")).alias("horizon_expected_points"),
        F.sum("fixture_count").alias("horizon_fixture_count"),
        F.count(F.lit(1)).alias("horizon_gameweeks"),
    )


def fixture_density(teams: DataFrame, gameweeks: DataFrame, fixtures: DataFrame,
                    season: str) -> DataFrame:
    """MRT-7 / FRC-6: fixtures per (team, period) on a dense grid with blank
    (0) and double (2+) flags."""
    periods = gameweeks.where(F.col("season") == F.lit(season)).select("gameweek_id").distinct()
    grid = teams.where(F.col("is_in_current_season")).select("team_code") \
        .crossJoin(bounded(periods))
    fx = _fixture_rows(fixtures).select(F.col("gameweek_id").alias("__gw"),
                                        F.col("team").alias("__team"), "fixture_id")
    j = grid.join(fx, (F.col("gameweek_id") == F.col("__gw")) & (F.col("team_code") == F.col("__team")),
                  "left")
    n = F.count("fixture_id")
    return j.groupBy("team_code", "gameweek_id").agg(
        n.alias("fixture_count"), (n == 0).alias("is_blank_gameweek"),
        (n >= 2).alias("is_double_gameweek"))


__all__ = [
    "DEFAULT_HORIZON", "target_periods", "league_strength", "expected_points_by_period",
    "expected_points_next", "expected_points_horizon", "fixture_density",
]
