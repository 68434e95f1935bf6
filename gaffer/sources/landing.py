"""Landing sources and sinks (SRC-1..8, SNK-1..5).

Raw snapshots are append-only: key columns + ``fetched_at`` + the payload as
JSON text, partitioned by ingest date. Row-level landing (one JSON line or CSV
row per record) is preferred so work splits across tasks; the array-in-a-cell
form of the reference is supported and followed by a ``repartition`` after
unnesting.
"""

from __future__ import annotations

import os
import threading
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaffer.session import checkpoint_dir, scratch_path



def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or a pattern, names anything."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(conf).globStatus(p)
    return found is not None and len(found) > 0


def input_state(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files under a folder: changes when they do."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return str(sorted(out))


def new_run_id() -> str:
    """The id that all rows of one landing call share; later calls sort after."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def empty_snapshot(spark: SparkSession, keys: dict[str, str]) -> DataFrame:
    schema = T.StructType([T.StructField(k, T._parse_datatype_string(t), True) for k, t in keys.items()]
                          + [T.StructField("fetched_at", T.TimestampType(), True),
                             T.StructField("payload", T.StringType(), True),
                             T.StructField("run_id", T.StringType(), True),
                             T.StructField("id", T.LongType(), True)])
    return spark.createDataFrame([], schema)


def land_json(spark: SparkSession, path: str | Sequence[str], keys: dict[str, str] | None = None,
              key_paths: dict[str, str] | None = None, fetched_at: str | None = None,
              whole_file: bool = False, missing_ok: bool = False,
              path_keys: dict[str, str] | None = None, run_id: str | None = None) -> DataFrame:
    """SRC-1/6: wrap JSON payloads with key columns, ``fetched_at``, ``run_id``
    and ``id``.

    ``whole_file``: each file is one payload (the reference's cell form);
    otherwise each line is one payload. ``keys`` names the key columns and their
    types. A key comes from the request when the payload lacks it: ``path_keys``
    maps key column -> regular expression with one group over the file path
    (``element_(\\d+)``), ``key_paths`` maps it to a JSON path (``$.entry_id``);
    without either it is read from ``$.<key>``. ``fetched_at`` defaults to the
    file's modification time. ``id`` numbers the rows of the call in file order,
    for payloads of one row each; staging prefers ``run_id`` where both are kept.
    A whole file also has its ``file``, so that of two files with one key and stamp
    staging reads the last by name, not both.
    A missing path yields no rows when ``missing_ok`` (a best-effort source).
    """
    keys = keys or {}
    paths = [path] if isinstance(path, str) else list(path)
    if missing_ok:
        paths = [p for p in paths if _exists(spark, p)]
        if not paths:
            return empty_snapshot(spark, keys)
    raw = spark.read.text(paths, wholetext=whole_file).select(
        F.col("value").alias("payload"), F.col("_metadata.file_modification_time").alias("__mtime"),
        F.col("_metadata.file_path").alias("__path"))
    ts = F.lit(fetched_at).cast("timestamp") if fetched_at else F.col("__mtime")

    def key(name: str, kind: str):
        if name in (path_keys or {}):
            found = F.regexp_extract("__path", path_keys[name], 1)
            return F.when(found != "", found).cast(kind).alias(name)
        return F.get_json_object("payload", (key_paths or {}).get(name, f"$.{name}")).cast(kind).alias(name)

    file = [F.col("__path").alias("file")] if whole_file else []
    return raw.where(F.length(F.trim("payload")) > 0).select(
        *[key(k, t) for k, t in keys.items()], ts.alias("fetched_at"), "payload",
        F.lit(run_id or new_run_id()).alias("run_id"), F.monotonically_increasing_id().alias("id"), *file)


def land_csv(spark: SparkSession, path: str | Sequence[str] | dict[str, str | Sequence[str]],
             season: str | None = None, fetched_at: str | None = None, as_cell: bool = False,
             cell_rows: int = 50_000, seasons: Sequence[str] | None = None,
             run_id: str | None = None) -> DataFrame:
    """SRC-2/3: CSV rows landed as all-string JSON objects (no inference).

    ``path`` is a file, pattern or folder, several, or one per season
    (``{"2024-25": path, ...}``). ``season`` defaults to a ``season=`` directory
    partition; ``seasons`` keeps a list of seasons. All rows of one call share
    ``run_id`` and ``fetched_at``, so a season may come from any number of files,
    rows or cells. With ``as_cell`` rows are packed into JSON-array cells of at
    most ``cell_rows`` rows (the reference stores a whole season per cell).
    """
    run_id = run_id or new_run_id()
    ts = F.lit(fetched_at).cast("timestamp") if fetched_at else \
        F.timestamp_micros(F.lit(time.time_ns() // 1000))
    if isinstance(path, dict):
        wanted = {k: v for k, v in path.items() if seasons is None or k in seasons}
        parts = [land_csv(spark, v, k, fetched_at, as_cell, cell_rows, None, run_id) for k, v in wanted.items()]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        # one landing time for all of the call's seasons
        return out.withColumn("fetched_at", ts)
    df = spark.read.csv(path if isinstance(path, str) else list(path), header=True, inferSchema=False)
    data_cols = [c for c in df.columns if c != "season"]
    # the folder's name as it is: as a partition column 2000-01 might be read as a date
    folder = F.regexp_extract("_metadata.file_path", r"season=([^/]+)", 1)
    rows = df.select((F.lit(season) if season else folder).alias("season"), ts.alias("fetched_at"),
                     F.struct(*[F.col(f"`{c}`") for c in data_cols]).alias("__r"))
    if seasons is not None:
        rows = rows.where(F.col("season").isin(list(seasons)))
    run = F.lit(run_id).alias("run_id")
    if not as_cell:
        return rows.select("season", "fetched_at", F.to_json("__r").alias("payload"), run)
    # bounded cells: the row id is (partition << 33) + row number in the
    # partition, so each cell holds at most ``cell_rows`` consecutive rows
    cell = F.floor(F.monotonically_increasing_id() / F.lit(cell_rows)).alias("__cell")
    return rows.select("*", cell).groupBy("season", "fetched_at", "__cell") \
        .agg(F.to_json(F.collect_list("__r")).alias("payload")).drop("__cell").withColumn("run_id", run)


def first_n(df: DataFrame, key: str, n: int | None = None, include: Sequence | None = None,
            skip: bool = False) -> DataFrame:
    """SRC-7: ``include`` keeps those entities only, ``n`` the first ``n`` by key
    (``--limit``; the limit is the feature here), ``skip`` leaves the source out."""
    if skip:
        return df.limit(0)
    out = df if include is None else df.where(F.col(key).isin(list(include)))
    return out if n is None else out.orderBy(key).limit(n)


def append_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ("ingest_date",)) -> None:
    """SNK-1: append a batch of snapshots, partitioned by ingest date."""
    out = df
    if "ingest_date" in partition_by and "ingest_date" not in df.columns:
        out = df.withColumn("ingest_date", F.to_date("fetched_at"))
    out.write.mode("append").partitionBy(*partition_by).parquet(path)


def publish(df: DataFrame, path: str) -> None:
    """SNK-3: full rebuild of a table."""
    df.write.mode("overwrite").parquet(path)


def materialized(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once under the shared folder and read back: cuts lineage for
    steps that read each other, and survives the loss of an executor."""
    path = scratch_path(df.sparkSession, f"{label}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def table(spark: SparkSession, path: str) -> DataFrame:
    """SRC-5: read a table by path."""
    return spark.read.parquet(path)


def append_batch(df: DataFrame, path: str, run_ts: str | None = None) -> None:
    """SNK-4/5: append one decision batch with a single ``generated_at``."""
    ts = F.lit(run_ts).cast("timestamp") if run_ts else F.current_timestamp()
    df.withColumn("generated_at", ts).write.mode("append").parquet(path)


_PUBLISHED: dict[tuple[str, str], str] = {}
_OBSERVED: dict[tuple[str, str], dict[str, int]] = {}
_LOCK = threading.Lock()


def published(spark: SparkSession, name: str) -> DataFrame | None:
    """The table materialised by :func:`publish_once` in this session, if any."""
    path = _PUBLISHED.get((spark.sparkContext.applicationId, name))
    return spark.read.parquet(path) if path else None


def publish_once(spark: SparkSession, name: str, df: DataFrame, watch: Sequence[str] = ()) -> DataFrame:
    """Materialise ``df`` once per session under the shared checkpoint folder
    (``spark.checkpoint.dir``) and return the table read back. The nulls of the ``watch``
    columns are counted while it is written (see :func:`observed_nulls`)."""
    app = spark.sparkContext.applicationId
    key = (app, name)
    with _LOCK:                      # one build per mart even if callers race
        if key not in _PUBLISHED:
            path = os.path.join(checkpoint_dir(spark), "marts", app, name)
            columns = [c for c in watch if c in df.columns]
            seen = Observation() if columns else None
            publish(df.observe(seen, *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]) if columns else df, path)
            _OBSERVED[key] = dict(seen.get) if columns else {}
            _PUBLISHED[key] = path
    return spark.read.parquet(_PUBLISHED[key])


def observed_nulls(spark: SparkSession, name: str) -> dict[str, int]:
    """Nulls by column of a table of :func:`publish_once`, as counted while it was written."""
    return _OBSERVED.get((spark.sparkContext.applicationId, name), {})
