"""STR-1: incremental latest-per-key over arriving snapshot files.

Plan: a streaming aggregation keeps, per key, the maximum of the struct
``(order columns..., values...)`` in the state store (partitioned by key, so
a hot key costs one state row, not its history); update mode emits only the
keys a micro-batch touched. The sink appends those changed rows to
``<table>/epoch=N`` (overwrite of that one folder, so a replayed epoch after an
executor or driver loss is idempotent). Every ``compact_every`` epochs the table so
far is written to ``<table>/upto=N`` and the folders it covers are deleted, so a
reader meets at most that many epochs. Readers take the latest row per key
across what is left, which equals the batch operator on the same files: a late
snapshot with an older ``fetched_at`` never replaces a newer one because
ordering is by the snapshot's own columns, not by arrival.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gaffer.operators.snapshots import latest_per_key
from gaffer.session import checkpoint_dir


def latest_struct_stream(stream: DataFrame, keys: Sequence[str], order: Sequence[str],
                         values: Sequence[str]) -> DataFrame:
    """Streaming aggregation: newest (by ``order``) values per key."""
    packed = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in values])
    return stream.groupBy(*keys).agg(F.max(packed).alias("__latest")) \
        .select(*keys, *[F.col(f"__latest.{c}").alias(c) for c in [*order, *values]])


def start_stream_latest(spark: SparkSession, source: str, schema: StructType,
                        keys: Sequence[str], order: Sequence[str], values: Sequence[str],
                        table: str, checkpoint: str, glob: str | None = None,
                        max_files_per_trigger: int | None = None,
                        available_now: bool = True, compact_every: int = 20) -> StreamingQuery:
    """Start the incremental operator over parquet files arriving in ``source``."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    agg = latest_struct_stream(reader.parquet(source), keys, order, values)

    def sink(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(table, f"epoch={epoch_id}"))
        if (epoch_id + 1) % compact_every == 0:
            compact(spark, table, keys, order, epoch_id)

    w = agg.writeStream.outputMode("update").foreachBatch(sink) \
        .option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _folders(spark: SparkSession, table: str) -> dict[str, dict[int, str]]:
    """The table's epoch and compacted folders that are complete."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(table)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[str, dict[int, str]] = {"epoch": {}, "upto": {}}
    for f in fs.listStatus(root):
        kind, _, n = f.getPath().getName().partition("=")
        done = jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS")
        if kind in out and fs.exists(done):
            out[kind][int(n)] = f.getPath().toString()
    return out


def compact(spark: SparkSession, table: str, keys: Sequence[str], order: Sequence[str], epoch: int) -> None:
    """Write the table up to ``epoch`` as one folder, then drop what it covers."""
    read_latest(spark, table, keys, order).write.mode("overwrite").parquet(os.path.join(table, f"upto={epoch}"))
    jvm = spark.sparkContext._jvm
    for kind, found in _folders(spark, table).items():
        for n, path in found.items():
            if n < epoch or (n == epoch and kind == "epoch"):
                p = jvm.org.apache.hadoop.fs.Path(path)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_latest(spark: SparkSession, table: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The current table: latest row per key over the newest compacted folder and
    the epochs after it."""
    found = _folders(spark, table)
    paths = [found["upto"][max(found["upto"])]] if found["upto"] else []
    paths += [p for n, p in sorted(found["epoch"].items()) if not found["upto"] or n > max(found["upto"])]
    return latest_per_key(spark.read.parquet(*paths), keys, list(order))


def stream_latest(spark: SparkSession, source: str, schema: StructType, keys: Sequence[str],
                  order: Sequence[str], values: Sequence[str], name: str,
                  glob: str | None = None, max_files_per_trigger: int | None = None,
                  compact_every: int = 20) -> DataFrame:
    """Run the stream over everything available and return the current table.
    State and output live under the shared checkpoint folder."""
    base = os.path.join(checkpoint_dir(spark), "streams", spark.sparkContext.applicationId, name)
    table, ckpt = os.path.join(base, "table"), os.path.join(base, "checkpoint")
    q = start_stream_latest(spark, source, schema, keys, order, values, table, ckpt, glob,
                            max_files_per_trigger, compact_every=compact_every)
    q.awaitTermination()
    return read_latest(spark, table, keys, order)
