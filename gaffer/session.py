"""Session construction and cluster-safe scratch locations.

All operators in this package are plain DataFrame functions; this module only
builds a session with the settings the operators assume (UTC session zone,
ANSI casts, adaptive execution) and resolves the shared checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every plan in the package relies on.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime (AQE) broadcast decision is the size check for every join whose
    # small side is not bounded by construction.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Spark's default; operators on long texts set fewer rows for their own queries
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    # A union reporting its children's hash partitioning lets a later join
    # skip an exchange, but with adaptive coalescing the two sides can end up
    # with different partition counts ("Can't zip RDDs"); keep it off.
    "spark.sql.unionOutputPartitioning": "false",
    # the last of repeated keys counts, as when a payload is read as text
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "gaffer",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf.setdefault("spark.driver.memory", os.environ.get("GAFFER_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of DEFAULT_CONF to an existing session."""
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            try:
                spark.conf.set(k, v)
            except Exception:  # pragma: no cover - static conf on a live session
                pass
    return spark


_FOLDERS: dict[str, str] = {}  # application id -> folder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. A private folder is only
    made when it is unset and the master is local (tests): on a cluster every
    machine would write to its own disk, so that is refused.
    """
    app = spark.sparkContext.applicationId
    if app in _FOLDERS:
        return _FOLDERS[app]
    d = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) \
        or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="gaffer-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        # RDD checkpoints (``DataFrame.checkpoint``) go to a subfolder of it
        spark.sparkContext.setCheckpointDir(os.path.join(d, "rdd"))
    _FOLDERS[app] = d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), "tables", name)
