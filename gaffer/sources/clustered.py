"""Landed tables clustered by key (SEL-2): latest-per-key without an exchange.

The table is bucketed by the key and sorted within its buckets, the counterpart of the
reference's indexes on (key, fetched_at). A bucket holds all rows of its keys, so a window per
key, a group per key or a join on the key reads buckets as they are. The number of buckets is
fixed when the table is made; choose it so that a bucket of the full table fits a task. A key
that holds a large part of all rows makes one large bucket: leave such a table unclustered, where
the map-side group limit cuts the key before the exchange.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def create_clustered(df: DataFrame, table: str, path: str, keys: Sequence[str], order: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as the clustered table ``table`` of the session's catalog, its files under ``path``."""
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")
    # one writing task per bucket, so that a bucket is one file
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet") \
        .bucketBy(buckets, *keys).sortBy(*keys, *order).option("path", path).saveAsTable(f"`{table}`")
    return spark.table(table)


def append_clustered(df: DataFrame, table: str) -> DataFrame:
    """Append a landing run to a clustered table, into the buckets that it has."""
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.mode("append").insertInto(table)
    return spark.table(table)
