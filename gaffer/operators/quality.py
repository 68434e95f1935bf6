"""Data-quality checks (DQ-1..4): each check returns its failing rows; the
suite runner returns one count row per check in a single job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, col: str) -> DataFrame:
    """DQ-1: rows whose column is NULL."""
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    """DQ-2: duplicated non-NULL values with their counts (T8)."""
    return df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .where(F.col("n") > 1)


def relationships(df: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """DQ-3: non-NULL child keys missing from the parent (left anti join)."""
    p = parent.select(F.col(field).alias("__pk")).where(F.col("__pk").isNotNull())
    return df.where(F.col(col).isNotNull()).join(p, F.col(col) == F.col("__pk"), "left_anti")


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str                      # not_null | unique | relationships | json_array
    df: DataFrame
    parent: DataFrame | None = None
    field: str | None = None

    def failures(self) -> DataFrame:
        if self.kind == "not_null":
            return not_null(self.df, self.column)
        if self.kind == "unique":
            return unique(self.df, self.column)
        if self.kind == "relationships":
            return relationships(self.df, self.column, self.parent, self.field)
        if self.kind == "json_array":
            # T10: payloads whose array (``field`` path, None = root) is absent
            # or not an array; the reference's unnest raises on these
            from gaffer.operators.nested import null_array_payloads
            return null_array_payloads(self.df, self.column, self.field)
        raise ValueError(self.kind)


def _in_one_pass(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failures of all not_null checks of one table: one scan, one aggregate."""
    total = df.agg(*[F.count_if(F.col(c.column).isNull()).alias(f"__n{i}") for i, c in enumerate(checks)])
    return total.select(F.inline(F.array(*[_line(c, F.col(f"__n{i}")) for i, c in enumerate(checks)])))


def _line(check: Check, failures) -> Column:
    return F.struct(F.lit(check.table).alias("table_name"), F.lit(check.column).alias("column_name"),
                    F.lit(check.kind).alias("check_name"), failures.cast("long").alias("failures"))


def _by_key(base: DataFrame, field: str, checks: Sequence[Check]) -> DataFrame:
    """The unique check of a key and all relationships to it: the key's table and its
    children are grouped by key once, with partial counts, so a hot key costs one row a task."""
    rows = base.select(F.col(field).alias("__k"), F.lit(-1).alias("__of"))
    for i, c in enumerate(checks):
        if c.kind == "relationships":
            rows = rows.union(c.df.select(F.col(c.column), F.lit(i)))
    have = F.sum(F.when(F.col("__of") == -1, 1).otherwise(0)).alias("__have")
    met = [F.sum(F.when(F.col("__of") == i, 1).otherwise(0)).alias(f"__n{i}") for i in range(len(checks))]
    keys = rows.where(F.col("__k").isNotNull()).groupBy("__k").agg(have, *met)
    bad = [F.count_if(F.col("__have") > 1) if c.kind == "unique"
           else F.coalesce(F.sum(F.when(F.col("__have") == 0, F.col(f"__n{i}"))), F.lit(0)) for i, c in enumerate(checks)]
    total = keys.agg(*[b.alias(f"__f{i}") for i, b in enumerate(bad)])
    return total.select(F.inline(F.array(*[_line(c, F.col(f"__f{i}")) for i, c in enumerate(checks)])))


def run_suite(checks: Sequence[Check], nulls: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """DQ-4: one row per check (table, column, check, failures); a unique check counts
    duplicated values, the others failing rows.

    ``nulls`` holds what is known of a table's nulls by column, e.g. from its writing:
    those not_null checks read nothing. The others of one table share one scan; a unique check and
    the relationships to the same key share one grouping."""
    parts, tables, keys, known = [], {}, {}, []
    for c in checks:
        if c.kind == "not_null" and c.column in (nulls or {}).get(c.table, {}):
            known.append((c.table, c.column, c.kind, nulls[c.table][c.column]))
        elif c.kind == "not_null":
            tables.setdefault(id(c.df), []).append(c)
        elif c.kind == "unique":
            keys.setdefault((id(c.df), c.column), (c.df, []))[1].append(c)
        elif c.kind == "relationships":
            keys.setdefault((id(c.parent), c.field), (c.parent, []))[1].append(c)
        else:
            parts.append(c.failures().agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(_line(c, F.col("n"))))))
    parts = [_in_one_pass(group[0].df, group) for group in tables.values()] \
        + [_by_key(base, field, group) for (_, field), (base, group) in keys.items()] + parts
    if known:
        spark = checks[0].df.sparkSession
        parts.append(spark.createDataFrame(known, "table_name string, column_name string, check_name string, failures long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
