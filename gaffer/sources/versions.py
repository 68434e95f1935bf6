"""Versioned publishing (SNK-3): readers see a whole set of tables, old or new.

A rebuild writes every table into a folder of its own, ``<root>/version=<n>/<table>``. When all
of them are written, one small pointer file ``<root>/current=<n>``, which names the folder of
each table, is put in place by a rename; readers follow the greatest pointer. So a reader during a rebuild, or after one that
failed, reads the version before it, and all tables of one version belong together. A table that
a rebuild leaves out stays as it was. The last ``keep`` versions stay for readers that are still at
them and for going back.
"""
from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def _numbers(spark: SparkSession, root: str, kind: str) -> list[int]:
    fs, path = _fs(spark, root)
    if not fs.exists(path(root)):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(path(root))]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}=") and n.partition("=")[2].isdigit())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The published versions that can still be read, in order."""
    return _numbers(spark, root, "current")


def _manifest(spark: SparkSession, root: str, number: int) -> dict[str, int]:
    """The version in whose folder each table of a published version lies."""
    return json.loads(spark.read.text(f"{root.rstrip('/')}/current={number}").first()[0])


def publish_version(spark: SparkSession, root: str, tables: Mapping[str, DataFrame | Callable[[], DataFrame]],
                    keep: int = 3) -> int:
    """Write all tables as one new version and make it the current one. If a table fails
    to build nothing changes for readers. Two rebuilds at a time get numbers of their own; the one
    that ends with the greater number is current. Returns the version."""
    if keep < 1:
        raise ValueError("at least one version is kept")
    root = root.rstrip("/")
    fs, path = _fs(spark, root)
    fs.mkdirs(path(root))
    number = max([0, *_numbers(spark, root, "version"), *_numbers(spark, root, "current")]) + 1
    while not _claim(fs, path, f"{root}/version={number}"):
        number += 1
    for name, table in tables.items():
        frame = table() if callable(table) else table
        frame.write.mode("overwrite").parquet(f"{root}/version={number}/{name}")
    known = versions(spark, root)
    manifest = (_manifest(spark, root, known[-1]) if known else {}) | {name: number for name in tables}
    _point(fs, path, root, number, manifest)
    drop_old(spark, root, keep)
    return number


def _claim(fs, path, folder: str) -> bool:
    """Whether this rebuild is the first to take the folder."""
    if fs.exists(path(folder)):
        return False
    fs.mkdirs(path(folder))
    mark = path(f"{folder}/_claim")
    return fs.createNewFile(mark)


def _point(fs, path, root: str, number: int, manifest: dict[str, int]) -> None:
    draft = path(f"{root}/_{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    if not fs.rename(draft, path(f"{root}/current={number}")):
        raise RuntimeError(f"version {number} is published already")


def go_back(spark: SparkSession, root: str) -> int:
    """Make the version before the current one current again, and return it."""
    known = versions(spark, root)
    if len(known) < 2:
        raise ValueError("there is no version to go back to")
    fs, path = _fs(spark, root)
    fs.delete(path(f"{root.rstrip('/')}/current={known[-1]}"), False)
    return known[-2]


def drop_old(spark: SparkSession, root: str, keep: int) -> None:
    """Delete the pointers before the last ``keep``, and the folders before the current one
    that no pointer left names, those of rebuilds that failed included."""
    root = root.rstrip("/")
    known = versions(spark, root)
    fs, path = _fs(spark, root)
    for n in known[:-keep]:
        fs.delete(path(f"{root}/current={n}"), False)
    used = {v for n in known[-keep:] for v in _manifest(spark, root, n).values()}
    for n in _numbers(spark, root, "version"):
        if known and n < known[-1] and n not in used:
            fs.delete(path(f"{root}/version={n}"), True)


def read_version(spark: SparkSession, root: str, table: str, version: int | None = None) -> DataFrame:
    """A table of the current version, or of a given one."""
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise ValueError(f"no published version {'' if version is None else version} under {root}")
    manifest = _manifest(spark, root, known[-1] if version is None else version)
    return spark.read.parquet(f"{root.rstrip('/')}/version={manifest[table]}/{table}")
