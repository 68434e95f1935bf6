"""Output normalisation shared by all registered queries: integral columns as
BIGINT, fractional ones as DOUBLE rounded to 6 digits, timestamps as text,
so results compare by value with the DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def normalize(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(t, T.DecimalType):
            # exact decimal rounding first, then the nearest double
            c = F.round(c, digits).cast("double")
        elif isinstance(t, (T.FloatType, T.DoubleType)):
            c = F.round(c, digits)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)
