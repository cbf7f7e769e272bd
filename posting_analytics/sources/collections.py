"""Named document collections stored as versioned folders.

A collection is a folder ``<root>/<name>`` with one folder per version in a
table format (Parquet keeps nested maps) and a manifest that names the current
one.  Replacing a collection writes a new version and then moves a new manifest
over the old one in a single step, so readers see the old rows or the new ones
and a failed write changes nothing.  Versions that are not current are kept
until ``drop_old_versions`` is called.  One writer per collection at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Files that begin with an underscore are no data to Spark's readers.
MANIFEST = "_current"


def collection_path(root: str, name: str) -> str:
    """The folder of a collection: its versions and its manifest."""
    return f"{root.rstrip('/')}/{name}"


def _hadoop(spark: SparkSession, path: str):
    """The path's file system, and the path as its own kind of object."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where, jvm


def _version(spark: SparkSession, root: str, name: str) -> str | None:
    fs, path, jvm = _hadoop(spark, f"{collection_path(root, name)}/{MANIFEST}")
    if not fs.exists(path):
        return None
    stream = fs.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """The folder of the current version of a collection."""
    version = _version(spark, root, name)
    if version is None:
        raise ValueError(f"no collection {name} under {root}")
    return f"{collection_path(root, name)}/{version}"


def _switch(spark: SparkSession, root: str, name: str, version: str) -> None:
    """Make ``version`` the current one: a new manifest is moved over the old."""
    folder = collection_path(root, name)
    fs, target, jvm = _hadoop(spark, f"{folder}/{MANIFEST}")
    fresh = jvm.org.apache.hadoop.fs.Path(f"{folder}/{MANIFEST}-{version}")
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(version.encode()))
    finally:
        out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(fresh), fs.makeQualified(target), options)


def replace_collection(df: DataFrame, root: str, name: str, fmt: str = "parquet") -> str:
    """Make the rows of ``df`` the collection ``name``; returns the new version's folder.

    ``df`` may read the collection that it replaces.
    """
    version = f"v-{uuid.uuid4().hex}"
    path = f"{collection_path(root, name)}/{version}"
    df.write.format(fmt).save(path)
    _switch(df.sparkSession, root, name, version)
    return path


def read_collection(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """The rows of the current version."""
    return spark.read.format(fmt).load(current_path(spark, root, name))


def old_versions(spark: SparkSession, root: str, name: str) -> list[str]:
    """The folders of versions that are not current, failed ones too, oldest first."""
    fs, path, _ = _hadoop(spark, collection_path(root, name))
    current = _version(spark, root, name)
    found = [(s.getModificationTime(), s.getPath().getName()) for s in fs.listStatus(path) if s.isDirectory()]
    return [f"{collection_path(root, name)}/{v}" for _, v in sorted(found) if v.startswith("v-") and v != current]


def restore_version(spark: SparkSession, root: str, name: str, path: str) -> None:
    """Make an old version the current one again."""
    if path not in old_versions(spark, root, name):
        raise ValueError(f"{path} is no old version of {name}")
    _switch(spark, root, name, path.rsplit("/", 1)[1])


def drop_old_versions(spark: SparkSession, root: str, name: str, keep: int = 0) -> list[str]:
    """Delete the versions that are not current, but for the ``keep`` newest; returns their folders."""
    old = old_versions(spark, root, name)
    gone = old[:len(old) - keep] if keep else old
    for path in gone:
        fs, where, _ = _hadoop(spark, path)
        fs.delete(where, True)
    return gone


def write_collections(frames: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict:
    """S7 for several collections; returns ``name -> path``."""
    return {name: replace_collection(df, root, name, fmt) for name, df in frames.items()}


def count_collections(spark: SparkSession, root: str, names: Iterable[str],
                      fmt: str = "parquet") -> DataFrame:
    """``(collection, n)`` for each collection, as one union of counts."""
    parts = [read_collection(spark, root, n, fmt).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(n).alias("collection"), "n") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
