"""Product queries: the stored tables of the whole job, run on feeds derived from the
shared tables.

The lake (feeds, landing, silver, gold, marts) is built once per session and input by the
job's own functions; each query returns one of its tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.plans import derived_feeds, gold, silver
from offerlake.plans.catalog import RUN_DATE
from offerlake.plans.job import Layout, build_silver
from offerlake.session import scratch_path
from offerlake.sources import bronze, feeds, sampling, sinks

_built: dict[tuple, dict] = {}

DIMS = ("dim_contrat", "dim_remote", "dim_metier", "dim_entreprise", "dim_experience", "dim_education", "dim_lieu", "dim_date")


def lake(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Every stored table of the job on feeds derived from ``sf``."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _built:
        base = scratch_path(spark, f"lake-{uuid.uuid4().hex[:12]}")
        layout = Layout(f"{base}/lake")
        sources = derived_feeds.write_feeds(spark, sf, f"{base}/raw")
        bronze.ingest(spark, layout.bronze, RUN_DATE, sources)
        build_silver(spark, layout, RUN_DATE)
        offers = sinks.read_silver(spark, layout.silver, RUN_DATE)
        rejects = sinks.read_rejects(spark, layout.silver, RUN_DATE)
        tables = gold.build(spark, offers, layout.warehouse)
        landed = {f"landed_{n}": bronze.read(spark, layout.bronze, n, RUN_DATE) for n in bronze.FEEDS}
        _built[key] = {**tables, **landed, "silver": offers, "rejects": rejects, "stats": silver.stats(offers, rejects, RUN_DATE)}
    return _built[key]


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("skills", F.array_join("skills", "|")) if "skills" in df.columns else df


def _table(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return _flat(lake(spark, sf)[name])
    run.__name__ = name
    return run


def landed_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Positions, keys and offer urls of all landed records; entries of the twin map have their url as key."""
    t = lake(spark, sf)
    parts = [t[f"landed_{n}"].select(F.lit(n).alias("feed"), "pos", "key", F.get_json_object("raw", "$.url").alias("url")) for n in bronze.FEEDS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def landed_twins(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.twin_urls(lake(spark, sf)["landed_cross_site"])


def feed_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Both feeds' samples, written as documents of the feed's own shape and read back."""
    t, base, parts = lake(spark, sf), scratch_path(spark, f"samples-{uuid.uuid4().hex[:12]}"), []
    for name, shape in (("wttj", "array"), ("indeed", "object")):
        sampling.write_sample(t[f"landed_{name}"], sampling.RECORDS[name], f"{base}/{name}", shape)
        parts.append(feeds.read_feed(spark, f"{base}/{name}").select(F.lit(name).alias("feed"), "pos", "key", F.get_json_object("raw", "$.url").alias("url")))
    return parts[0].unionByName(parts[1])


QUERIES = {
    "product_feed_samples": feed_samples,
    "product_landed_records": landed_keys,
    "product_twin_urls": landed_twins,
    "product_silver_offers": _table("silver"),
    "product_silver_rejects": _table("rejects"),
    "product_run_stats": _table("stats"),
    "product_staging": _table("stg_offres"),
    "product_valid_offers": _table("int_offres_valides"),
    "product_fact": _table("fct_offres"),
    **{f"product_{name}": _table(name) for name in (*DIMS, *gold.MART_NAMES)},
}
