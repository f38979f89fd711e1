"""Immutable bronze landing, manifest and time-travel reads.

Layout: ``<root>/<source>/dt=<run_date>/<version>/`` holds the exploded raw records
(``pos``, ``key``, ``raw``) of one run, and the pointer beside it (see ``published``) names
the version that counts.  A date, once published, is never replaced: later runs leave it
untouched, and of several landings at the same time the first to publish decides, whose
rows all of them read.  What a crashed run left unpublished is not seen; reading a date
that holds nothing else is an error.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from offerlake.schemas import BRONZE_ROWS
from offerlake.session import passing_scratch
from offerlake.sources import feeds, published

FEEDS = ("wttj", "indeed", "cross_site")


def partition_path(root: str, name: str, run_date: str) -> str:
    return f"{root.rstrip('/')}/{name}/dt={run_date}"


def committed(spark: SparkSession, path: str) -> bool:
    return published.current(spark, path) is not None


def land(spark: SparkSession, root: str, name: str, src: str | None | Sequence[str | None], run_date: str) -> dict:
    """Land one source for ``run_date``: the first of its candidates that is there; absent
    source -> ``present: False``."""
    dest = partition_path(root, name, run_date)
    found = feeds.resolve(spark, src)
    if found is None:
        return {"source": name, "path": dest, "origin": str(src), "present": False}
    src = found
    if not committed(spark, dest):
        version = published.new_version()
        with passing_scratch(spark):
            rows = feeds.read_twin_map(spark, src) if name == "cross_site" else feeds.read_feed(spark, src)
            rows.write.option("compression", "zstd").parquet(f"{dest}/{version}")
        published.publish(spark, dest, version, exclusive=True)
    return {"source": name, "path": dest, "origin": str(src), "present": True}


def ingest(spark: SparkSession, root: str, run_date: str, sources: dict[str, str | None | Sequence[str | None]]) -> dict:
    """Land every source and write the manifest (overwritten each run)."""
    manifest = {"run_date": run_date,
                "sources": [land(spark, root, n, sources.get(n), run_date) for n in FEEDS]}
    (spark.createDataFrame([(json.dumps(manifest, ensure_ascii=False),)], "value string")
          .coalesce(1).write.mode("overwrite").text(f"{root.rstrip('/')}/_manifest"))
    return manifest


def read_manifest(spark: SparkSession, root: str) -> dict:
    return json.loads(spark.read.text(f"{root.rstrip('/')}/_manifest").first()[0])


def read(spark: SparkSession, root: str, name: str, run_date: str) -> DataFrame:
    """Records of ``name`` landed for ``run_date`` (empty when never landed)."""
    dest = partition_path(root, name, run_date)
    version = published.current(spark, dest)
    if version is None:
        fs, p = published.file_system(spark, dest)
        if fs.exists(p):
            raise feeds.MalformedFeedError(f"{dest} was not committed; land it again")
        return spark.createDataFrame([], BRONZE_ROWS)
    return spark.read.schema(BRONZE_ROWS).parquet(f"{dest}/{version}").select("pos", "key", "raw")
