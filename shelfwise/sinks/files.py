"""Small files of the shared store, reached through Spark's own file systems, so
that paths of any store that Spark writes to will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _fs(spark, path)
    return fs.exists(target)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder; nothing happens if there is none."""
    target, fs = _fs(spark, path)
    fs.delete(target, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, oldest first; none if there is no such folder."""
    target, fs = _fs(spark, path)
    if not fs.exists(target):
        return []
    found = sorted(fs.listStatus(target), key=lambda s: (s.getModificationTime(), s.getPath().getName()))
    return [s.getPath().getName() for s in found]


def read_text(spark: SparkSession, path: str) -> str | None:
    target, fs = _fs(spark, path)
    if not fs.exists(target):
        return None
    return "".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def swap_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one.
    The text is written under another name and renamed over the file."""
    jvm = spark.sparkContext._jvm
    target, fs = _fs(spark, path)
    fresh = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    out = fs.create(fresh, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(fresh), fs.makeQualified(target), options)
