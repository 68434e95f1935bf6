"""Helpers shared by the training-data operators: tables, shared storage, components."""
from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaffer.session import checkpoint_dir

# The contract's word: a run of characters other than these six.
SPACES = " \t\n\x0b\x0c\r"
WORD_REGEX = r"[^\x20\x09-\x0D]+"

# Rows per Arrow batch: texts may be very long, so batches hold few rows.
ARROW_ROWS = 500


_caches: dict[str, dict] = {}


def worker_cache(name: str) -> dict:
    """An operator's cache in this Python worker. Spark reuses workers between
    stages, so what other operators have cached is dropped first: a worker holds
    one bounded cache at a time."""
    if name not in _caches:
        for other in _caches.values():
            other.clear()
        _caches.clear()
        _caches[name] = {}
    return _caches[name]


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    # adaptive execution takes the cluster's own limit for measured broadcasts
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    return spark


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, release: bool = False) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts
    lineage, and a lost executor rereads the table instead of recomputing.
    ``release`` then lets Spark's cleaner drop the shuffle files that led to it,
    which it does when the driver collects its garbage."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    if release:
        del df
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path)


def in_holdout(id_col: str = "doc_id"):
    """True for the rows whose labels must not be learnt."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """Connected components of ``edges(a long, b long)``: rows (node, component)
    with component = the smallest node reachable, for every node of an edge.

    Rounds of large-star / small-star: every node hangs its larger neighbours
    on its smallest one, then its smaller neighbours. Each round is a grouped
    minimum (partially aggregated, so a hub with very many neighbours is never
    gathered) and a join whose skewed keys adaptive execution splits. It ends
    when a round changes nothing; every round is stored in the shared folder.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .where("u > v").distinct()
    links = stored(links, "cc")
    # star links are a set, so equal count and sum of hashes mean that nothing changed
    def state(rows):
        return rows.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                        F.sum(F.xxhash64("v", "u", F.lit(1)).cast("decimal(38,0)"))).first()

    before = state(links)
    for _ in range(max_rounds):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: neighbours above u hang on the least of u's neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .where("u > v").distinct()
        # small star: u and its smaller neighbours hang on the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        small = stored(small, "cc")
        links, after = small, state(small)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not converge")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component")))
