"""Versioned tables: a reader sees a whole version or the one before it.

A version is a folder ``version=N`` that counts once its job committed. A
micro-batch that is retried writes the same version again.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_NAME = re.compile(r"version=(\d+)$")


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def committed_versions(spark: SparkSession, path: str) -> list[int]:
    fs, root = _fs(spark, path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        hit = _NAME.search(status.getPath().getName())
        if hit and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
            found.append(int(hit.group(1)))
    return sorted(found)


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/version={version}"


def latest_version(spark: SparkSession, path: str, before: int | None = None) -> str | None:
    """Path of the newest committed version, optionally of those below ``before``."""
    versions = [v for v in committed_versions(spark, path) if before is None or v < before]
    return version_path(path, versions[-1]) if versions else None


def write_version(df: DataFrame, path: str, version: int, keep: int = 2, files: int | None = None,
                  fmt: str = "parquet") -> None:
    """Write one version and drop all but the newest ``keep``.

    ``files`` limits the number of files of a table known to be small. Newer
    versions can only come from another checkpoint; they are not overwritten.
    """
    spark = df.sparkSession
    if any(v > version for v in committed_versions(spark, path)):
        raise ValueError(f"{path} has versions after {version}: reset it before starting from a new checkpoint")
    (df.coalesce(files) if files else df).write.format(fmt).mode("overwrite").save(version_path(path, version))
    versions = committed_versions(spark, path)
    for old in versions[:-keep]:
        fs, p = _fs(spark, version_path(path, old))
        fs.delete(p, True)


def reset(spark: SparkSession, path: str) -> None:
    """Drop a materialised table. Nothing calls this implicitly; a restarted stream needs a new checkpoint too."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)
