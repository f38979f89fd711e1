"""Versions of tables and the pointer that readers follow.

A writer puts a whole version into a folder with a name of its own, checks it, and then
publishes it: a small file with the version's name is written beside and renamed into place.
Readers resolve the pointer first, so they see an old version or a new one, never half of
one; a version that was never published is invisible.  Renaming is as atomic as the store
makes it (HDFS: entirely); ``exclusive`` publishing never replaces a pointer, so of several
writers one decides and the others read what it published.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

POINTER = "_CURRENT"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in it: any store that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def new_version(prefix: str = "v") -> str:
    return f"{prefix}-{uuid.uuid4().hex}"


def current(spark: SparkSession, folder: str) -> str | None:
    """Name of the version that ``folder`` has published, None if there is none."""
    fs, p = file_system(spark, f"{folder}/{POINTER}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, folder: str, version: str, *, exclusive: bool = False) -> str:
    """Point ``folder`` to ``version``; the version it points to afterwards."""
    jvm = spark._jvm
    fs, target = file_system(spark, f"{folder}/{POINTER}")
    _, draft = file_system(spark, f"{folder}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(version.encode())
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    option = spark.sparkContext._gateway.new_array(rename, 1)
    option[0] = getattr(rename, "NONE" if exclusive else "OVERWRITE")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri() if target.isUriPathAbsolute() and target.toUri().getScheme() else fs.getUri(),
                                                                  spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, target, option)
    except Exception as e:
        fs.delete(draft, False)
        if not exclusive or "FileAlreadyExistsException" not in str(e):
            raise
    return current(spark, folder)
