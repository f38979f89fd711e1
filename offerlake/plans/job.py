"""The whole job: land -> silver -> gold -> checks -> export.

``run_job`` is the entry point a scheduler calls; it returns the run
statistics.  Every stage is a Spark plan; the driver only sees small
results (manifest, one-row statistics, the check report).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from offerlake.operators import quality
from offerlake.plans import gold, silver
from offerlake.session import passing_scratch
from offerlake.sources import bronze, sinks


@dataclass
class Layout:
    """Folder layout of the lakehouse under one root."""
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def warehouse(self) -> str:
        return f"{self.root}/warehouse"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"


def build_silver(spark: SparkSession, layout: Layout, run_date: str) -> dict:
    """Write, audit, publish: rows are checked and counted while they are written to a
    version of their own; invalid ones stop the job, and readers keep what they had."""
    rows_a = bronze.read(spark, layout.bronze, "wttj", run_date)
    rows_b = bronze.read(spark, layout.bronze, "indeed", run_date)
    twins = bronze.read(spark, layout.bronze, "cross_site", run_date)
    with passing_scratch(spark):
        offers, rejects = silver.build(rows_a, rows_b, twins, run_date)
        audited = silver.Audited(offers, rejects)
        version = sinks.stage_silver(audited.offers, audited.rejects, layout.silver, run_date)
        stats = audited.stats(run_date)
    sinks.publish_silver(spark, layout.silver, run_date, version)
    return stats


def _write_stats(spark: SparkSession, layout: Layout, stats: dict) -> None:
    spark.createDataFrame([(json.dumps(stats, ensure_ascii=False, default=str),)], "value string") \
         .coalesce(1).write.mode("overwrite").text(f"{layout.root}/_last_run")


def run_job(spark: SparkSession, root: str, run_date: str, sources: dict[str, str | None], *,
            skip_gold: bool = False, export: bool = True, exclude_tags: tuple[str, ...] = (),
            expected_counts: dict[str, int] | None = None, object_store: str | None = None) -> dict:
    layout = Layout(root.rstrip("/"))
    manifest = bronze.ingest(spark, layout.bronze, run_date, sources)
    stats = build_silver(spark, layout, run_date)
    stats["present"] = {s["source"]: s["present"] for s in manifest["sources"]}
    _write_stats(spark, layout, stats)               # a run without gold has its statistics, too
    if skip_gold:
        return stats
    s = sinks.read_silver(spark, layout.silver, run_date)
    tables = gold.build(spark, s, layout.warehouse)
    report = quality.check_report(
        gold.checks(tables["stg_offres"], tables["int_offres_valides"], tables["fct_offres"],
                    {n: t for n, t in tables.items() if n.startswith("dim_")},
                    {n: t for n, t in tables.items() if n.startswith("mart_")}, expected_counts),
        exclude_tags=exclude_tags)
    failed = report.where((F.col("severity") == "error") & (F.col("failures") > 0)).collect()
    stats["failed_checks"] = {r.check: r.failures for r in failed}
    stats["gold_ok"] = not failed
    if not failed and export:
        names = sinks.list_marts(tables) + ["fct_offres"]
        stats["gold_exported"] = sinks.export(tables, names, layout.gold)
        stats["object_store_files"] = sinks.sync_to_object_store(tables, names, object_store)
    _write_stats(spark, layout, stats)
    return stats
