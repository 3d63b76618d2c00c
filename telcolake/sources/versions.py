"""Published versions of a layer: a job writes beside the old version, readers switch when it is complete.

A version is a folder below the layer's root whose name sorts by time. It counts as published
once it holds a marker, which is written last; so a job that fails leaves readers on the
version before, and no file is renamed or copied. Catalog tables are entries over the
folders of a version: publishing moves each entry to the new folder, one by one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

MARKER = "_PUBLISHED"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def new_version(root: str) -> str:
    """A folder name below ``root`` that sorts after all earlier ones."""
    return f"{root}/v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, version: str) -> str:
    """Make a completely written version the current one."""
    marker, files = _path(spark, f"{version}/{MARKER}")
    files.create(marker, True).close()
    return version


def published(spark: SparkSession, root: str) -> list[str]:
    """Published versions below ``root``, oldest first."""
    pattern, files = _path(spark, f"{root}/v*/{MARKER}")
    found = files.globStatus(pattern) or []
    return sorted(f"{root}/{status.getPath().getParent().getName()}" for status in found)


def current(spark: SparkSession, root: str) -> str:
    """The folder that readers of ``root`` read: its last published version, or ``root`` itself where none is."""
    versions = published(spark, root)
    return versions[-1] if versions else root


def expire(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` published versions, and unpublished ones older than the current."""
    if keep < 1:
        raise ValueError("the current version is kept")
    versions = published(spark, root)
    if not versions:
        return []
    kept = set(versions[-keep:])
    pattern, files = _path(spark, f"{root}/v*")
    gone = []
    for status in files.globStatus(pattern) or []:
        folder = f"{root}/{status.getPath().getName()}"
        if folder not in kept and folder < versions[-1]:
            files.delete(status.getPath(), True)
            gone.append(folder)
    return sorted(gone)


@dataclass(frozen=True)
class Entry:
    """A catalog table over a folder: its columns as DDL and the columns that part its files."""

    folder: str
    ddl: str
    partitioned_by: tuple[str, ...] = ()


def publish_tables(spark: SparkSession, schema: str, entries: Mapping[str, Entry], fmt: str = "parquet") -> None:
    """Point the catalog's tables at new folders; create those that are missing.

    Each entry moves at once; files are neither copied nor moved. Partitions are found in the
    folder, not kept in the catalog, so an entry never names those of an old version.
    """
    by_catalog = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(by_catalog)
    for name, entry in entries.items():
        table = f"{schema}.{name}"
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{entry.folder}'")
            spark.catalog.refreshTable(table)
            continue
        parted = f" PARTITIONED BY ({', '.join(entry.partitioned_by)})" if entry.partitioned_by else ""
        spark.conf.set(by_catalog, "false")
        try:
            spark.sql(f"CREATE TABLE {table} ({entry.ddl}) USING {fmt}{parted} LOCATION '{entry.folder}'")
        finally:
            spark.conf.set(by_catalog, before)
