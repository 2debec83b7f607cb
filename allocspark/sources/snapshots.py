"""Versioned snapshots of a folder: all or nothing for readers.

Data is only ever written to new folders. A version is a small manifest that names the folders which
count; it is created once, under its number, and never changed. Readers take the highest whole
manifest, so between two versions they see the old state or the new one. Two writers that start from
one version can't both publish the next: the file of a number can be created once.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

EMPTY = {"version": 0, "batches": [], "parts": {}, "folders": {}}


class Conflict(RuntimeError):
    """Another writer published first; read the new state and try again."""


def _files(spark: SparkSession, root: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/_manifests")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system Spark can read; none if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(path)] if files.exists(path) else []


def _versions(spark: SparkSession, root: str) -> list[int]:
    found = [name.removesuffix(".json") for name in names(spark, f"{root.rstrip('/')}/_manifests")]
    return sorted(int(name) for name in found if name.isdigit())


def _path(spark: SparkSession, folder, version: int):
    return spark._jvm.org.apache.hadoop.fs.Path(folder, f"{version:012d}.json")


def current(spark: SparkSession, root: str) -> dict:
    """The manifest that counts; that of an empty state if nothing was published yet. A manifest whose
    writer was lost before it was whole doesn't count."""
    files, folder = _files(spark, root)
    for version in reversed(_versions(spark, root)):
        stream = files.open(_path(spark, folder, version))
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            continue
    return json.loads(json.dumps(EMPTY))


def publish(spark: SparkSession, root: str, manifest: dict, base: dict) -> dict:
    """``manifest`` as the version that follows ``base``."""
    if current(spark, root)["version"] != base["version"]:
        raise Conflict(f"{root} has moved on from version {base['version']}")
    files, folder = _files(spark, root)
    version = max(_versions(spark, root), default=0) + 1
    fresh = manifest | {"version": version}
    try:
        stream = files.create(_path(spark, folder, version), False)
    except Exception as error:
        if "AlreadyExists" in str(error):
            raise Conflict(f"{root} has a version {version} now") from error
        raise
    stream.write(bytearray(json.dumps(fresh).encode()))
    stream.close()
    return fresh
