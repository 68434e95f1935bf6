"""Join operators: role-playing dimensions, one-row relations, fixture sides.

Broadcast policy: a side is hinted for broadcast only when its size is bounded
by construction (a one-row aggregate, a literal table, a grid of at most
``horizon`` periods). Every other dimension is joined without a hint and the
adaptive planner broadcasts it only if its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a
shuffle join. That runtime measurement is the size check.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded(df: DataFrame) -> DataFrame:
    """Broadcast hint for a relation whose row count is bounded by
    construction (literal tables, one-row aggregates, horizon grids)."""
    return F.broadcast(df)


def enrich_roles(df: DataFrame, dim: DataFrame, dim_key: str,
                 roles: dict[str, str], take: dict[str, str],
                 how: str = "left") -> DataFrame:
    """JN-6: the same dimension joined once per role.

    ``roles`` maps role -> fact column holding the key; ``take`` maps dim
    column -> output suffix. Output columns are ``{role}_{suffix}``.
    """
    out = df
    for role, fk in roles.items():
        d = dim.select(F.col(dim_key).alias(f"__{role}_k"),
                       *[F.col(c).alias(f"{role}_{sfx}") for c, sfx in take.items()])
        out = out.join(d, F.col(fk) == F.col(f"__{role}_k"), how).drop(f"__{role}_k")
    return out


def with_scalar_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """JN-10: attach a one-row relation (a global aggregate) to every row."""
    return df.crossJoin(bounded(row))


def entity_fixtures(fixtures: DataFrame, fixture_id: str, home: str, away: str,
                    extra: Sequence[str] = ()) -> DataFrame:
    """JN-9 rewrite: one row per (fixture, team side) with the opponent and a
    home flag, so "team is home OR away" becomes a pure equi join on team.

    A fixture whose two sides are the same team yields one row (T13).
    """
    home_rows = fixtures.select(F.col(fixture_id), *extra, F.col(home).alias("team"),
                                F.col(away).alias("opponent"), F.lit(True).alias("is_home"))
    away_rows = fixtures.where(~F.col(home).eqNullSafe(F.col(away))) \
        .select(F.col(fixture_id), *extra, F.col(away).alias("team"),
                F.col(home).alias("opponent"), F.lit(False).alias("is_home"))
    return home_rows.unionByName(away_rows)
