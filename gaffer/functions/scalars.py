"""Scalar Column functions (cleaning, casting, safe arithmetic).

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def typed(col, dtype: DataType | str, lenient: bool = False) -> Column:
    """Cast text to a type. Strict (ANSI, raises on bad input) by default;
    ``lenient`` gives NULL instead."""
    c = _c(col)
    return c.try_cast(dtype) if lenient else c.cast(dtype)


def blank_to_null(col) -> Column:
    """``''`` -> NULL (CSV rows land as all-string objects)."""
    return F.nullif(_c(col), F.lit(""))


def sentinel_to_null(col, sentinels=("", "None")) -> Column:
    """Nested sentinel cleaning: each listed value becomes NULL."""
    c = _c(col)
    for s in sentinels:
        c = F.nullif(c, F.lit(s))
    return c


def zero_to_null(col) -> Column:
    """0 means "not published" -> NULL."""
    return F.nullif(_c(col), F.lit(0))


def safe_div(num, den) -> Column:
    """``num / nullif(den, 0)``: NULL instead of an ANSI divide-by-zero error."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def tenths(col, precision: int = 6) -> Column:
    """Integer tenths (e.g. price 55 -> 5.5) as an exact decimal."""
    return (_c(col).cast("decimal(10,1)") / F.lit(10)).cast(f"decimal({precision},1)")


def first_of(*cols) -> Column:
    """Multi-source fallback."""
    return F.coalesce(*[_c(c) for c in cols])


def default(col, value) -> Column:
    return F.coalesce(_c(col), F.lit(value))


def decay(base: float, n) -> Column:
    """Geometric decay ``base ** n`` (double)."""
    return F.pow(F.lit(float(base)), _c(n))


def season_year(col) -> Column:
    """Start year of a season label such as ``'2026-27'``."""
    return F.substring(_c(col), 1, 4).cast("int")


def season_label(year_col) -> Column:
    """Inverse of :func:`season_year`: 2026 -> ``'2026-27'``."""
    y = _c(year_col).cast("int")
    return F.concat(y.cast("string"), F.lit("-"),
                    F.lpad(((y + 1) % 100).cast("string"), 2, "0"))


def typed_null(dtype: DataType | str) -> Column:
    """Typed NULL so that set-operation schemas line up."""
    return F.lit(None).cast(dtype)


def in_tenths(col) -> Column:
    """Money held as integer tenths (exact; avoids half-even vs half-up)."""
    return F.round(_c(col) * 10).cast("bigint")


def half_floor(col) -> Column:
    """``floor(x / 2)`` on integer tenths."""
    return F.floor(_c(col) / 2).cast("bigint")


def sell_value_tenths(current_tenths, purchase_tenths) -> Column:
    """Sale price under a 50% sell-on fee: half of any rise is kept (rounded
    down), a fall is taken in full. All arguments in integer tenths."""
    cur, buy = _c(current_tenths), _c(purchase_tenths)
    return F.when(cur > buy, buy + half_floor(cur - buy)).otherwise(cur)


def sell_value(current_price, purchase_price) -> Column:
    """Sell value in units (double) from prices in units."""
    return sell_value_tenths(in_tenths(current_price), in_tenths(purchase_price)) / F.lit(10.0)
