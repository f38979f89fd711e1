"""Session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Defaults that matter for correctness and for the shape of the plans.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, app: str = "offerlake",
              shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**_DEFAULTS, **conf}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read.  It
    is filled in here only when unset (local runs and tests), with a fresh
    folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = tempfile.mkdtemp(prefix="offerlake-ckpt-")   # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """What ``materialize`` writes inside is deleted at the end, and the shuffle files of a
    query as soon as it has ended: for a step whose results are stored elsewhere.  A
    DataFrame that reads such a table must not outlive the step."""
    paths: list[str] = []
    token, before = _passing.set(paths), spark.conf.get(_DROP_SHUFFLES, "false")
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
        _passing.reset(token)
        for path in paths:
            drop_scratch(spark, path)


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table under the shared checkpoint folder, in whatever store that is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def materialize(df, name: str, compression: str | None = None):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: a lineage cut that computes the plan a single time and
    survives executor loss (unlike cached blocks)."""
    path = scratch_table(df, name, compression)
    if (passing := _passing.get()) is not None:
        passing.append(path)
    return df.sparkSession.read.parquet(path)


def scratch_table(df, name: str, compression: str | None = None) -> str:
    """Write ``df`` as a table of its own under the shared checkpoint folder; its path.  It stays
    after ``passing_scratch``."""
    import uuid

    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").options(**({"compression": compression} if compression else {})).parquet(path)
    return path
