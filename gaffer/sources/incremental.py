"""Incremental landing (SRC-1, SRC-6, SNK-1): every file lands exactly once.

A streaming file source reads what is new in a folder and appends it to a landed
table; Spark's checkpoint remembers the files that are done and the table's own log names
the files that count. So a run lands only files that no run before has landed, a run that was killed
lands nothing twice when it is started again, and readers never see half a run. All
rows of one run share ``run_id``, taken from the run's time in the checkpoint, which stays
the same when the run is repeated.

Whole-file payloads carry their ``file``: of two payloads of a key with one stamp the last by
file name counts (see ``staging.newest``), never both.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A file counts as new however old its time is (the source's default leaves out what is a week
# older than the newest file).
ANY_AGE = "36500d"
# order of a landed table's payloads of one key, the greatest is the newest
NEWEST = ["fetched_at", "run_id", "file"]


def _run_columns(fetched_at: Column) -> list[Column]:
    now = F.current_timestamp()  # the run's own, as the checkpoint has it
    return [fetched_at.alias("fetched_at"), F.date_format(now, "yyyyMMddHHmmssSSS").alias("run_id"),
            F.col("_metadata.file_path").alias("file"), F.to_date(now).alias("ingest_date")]


def json_files(spark: SparkSession, folder: str, keys: dict[str, str] | None = None,
               key_paths: dict[str, str] | None = None, path_keys: dict[str, str] | None = None,
               whole_file: bool = True, glob: str = "*", files_per_batch: int = 10_000) -> DataFrame:
    """A stream of the JSON payloads in a folder and below it: the key columns, ``fetched_at``
    (the file's time), ``run_id``, ``file``, ``ingest_date`` and ``payload``.

    ``keys``, ``key_paths`` and ``path_keys`` are those of ``landing.land_json``; a payload
    without a key has a null one. Blank files and lines are no payloads."""
    raw = spark.readStream.option("wholetext", str(whole_file).lower()).option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", glob).option("maxFilesPerTrigger", str(files_per_batch)) \
        .option("maxFileAge", ANY_AGE).text(folder)

    def key(name: str, kind: str) -> Column:
        if name in (path_keys or {}):
            found = F.regexp_extract("_metadata.file_path", path_keys[name], 1)
            return F.when(found != "", found).cast(kind).alias(name)
        return F.get_json_object("value", (key_paths or {}).get(name, f"$.{name}")).cast(kind).alias(name)
    return raw.where(F.length(F.trim("value")) > 0).select(
        *[key(k, t) for k, t in (keys or {}).items()], *_run_columns(F.col("_metadata.file_modification_time")),
        F.col("value").alias("payload"))


def csv_files(spark: SparkSession, folder: str, columns: Sequence[str], glob: str = "*.csv",
              seasons: Sequence[str] | None = None, files_per_batch: int = 10_000) -> DataFrame:
    """A stream of CSV rows as JSON payloads of text fields (SRC-2, SRC-3); ``season`` is taken
    from a ``season=`` folder, ``seasons`` keeps a list of them."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.readStream.schema(schema).option("header", "true").option("recursiveFileLookup", "true") \
        .option("pathGlobFilter", glob).option("maxFilesPerTrigger", str(files_per_batch)) \
        .option("maxFileAge", ANY_AGE).csv(folder)
    season = F.regexp_extract("_metadata.file_path", r"season=([^/]+)", 1).alias("season")
    rows = raw.select(season, *_run_columns(F.col("_metadata.file_modification_time")),
                      F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("payload"))
    return rows if seasons is None else rows.where(F.col("season").isin(list(seasons)))


def land_new(payloads: DataFrame, table: str, checkpoint: str) -> int:
    """Append everything new of a stream to the landed table, and return the number of rows
    read. Safe to run again at any time; one run at a time per checkpoint."""
    query = payloads.writeStream.format("parquet").partitionBy("ingest_date") \
        .option("path", table).option("checkpointLocation", checkpoint).outputMode("append") \
        .trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)


def landed(spark: SparkSession, table: str) -> DataFrame:
    """The landed rows of all runs that ended."""
    return spark.read.parquet(table)
