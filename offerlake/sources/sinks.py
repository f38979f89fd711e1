"""Table writers and readers: silver with its rejects, gold export, object-store copy.

Silver and gold are written as versions and published by one pointer each (see
``published``): offers and rejects of a run date together, all gold tables together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerlake.schemas import REJECTS, SILVER
from offerlake.sources import published


def write_partition(df: DataFrame, path: str, run_date: str) -> None:
    """Overwrite the ``run_date=<run_date>`` partition of ``path`` only.

    Other dates are untouched, re-running a date replaces it, and an empty
    result still writes a (schema-only) file, so the table always exists.
    """
    (df.drop("run_date").write.mode("overwrite")
       .parquet(f"{path.rstrip('/')}/run_date={run_date}"))


def read_partition(spark: SparkSession, path: str, run_date: str, schema=SILVER) -> DataFrame:
    return spark.read.schema(schema).parquet(path).where(f"run_date = '{run_date}'")


def _date(silver: str, run_date: str) -> str:
    return f"{silver.rstrip('/')}/published/run_date={run_date}"


def stage_silver(offers: DataFrame, rejects: DataFrame, silver: str, run_date: str) -> str:
    """Write both tables of a run date as a new version that no reader sees; its name."""
    version = published.new_version()
    base = f"{silver.rstrip('/')}/{version}"
    write_partition(offers, f"{base}/offres", run_date)
    write_partition(rejects, f"{base}/rejets_salaire", run_date)
    return version


def publish_silver(spark: SparkSession, silver: str, run_date: str, version: str) -> None:
    """From now on readers of ``run_date`` get ``version``: offers and rejects at once."""
    published.publish(spark, _date(silver, run_date), version)


def _version(spark: SparkSession, silver: str, run_date: str) -> str | None:
    version = published.current(spark, _date(silver, run_date))
    return version and f"{silver.rstrip('/')}/{version}"


def read_silver(spark: SparkSession, silver: str, run_date: str) -> DataFrame:
    """The published offers of a run date (none before the first publication)."""
    base = _version(spark, silver, run_date)
    return read_partition(spark, f"{base}/offres", run_date) if base else spark.createDataFrame([], SILVER)


def read_rejects(spark: SparkSession, silver: str, run_date: str) -> DataFrame:
    base = _version(spark, silver, run_date)
    return read_partition(spark, f"{base}/rejets_salaire", run_date, REJECTS) if base else spark.createDataFrame([], REJECTS)


def export(tables: dict[str, DataFrame], names: list[str], gold_dir: str) -> list[str]:
    """Write the named tables as one version and switch readers to it when all are there; a
    crash before that leaves the version published before."""
    version, base = published.new_version(), gold_dir.rstrip("/")
    for n in names:
        tables[n].write.parquet(f"{base}/{version}/{n}.parquet")
    if names:
        published.publish(tables[names[0]].sparkSession, base, version)
    return list(names)


def gold_table(spark: SparkSession, gold_dir: str, name: str) -> DataFrame:
    """A table of the published version."""
    base = gold_dir.rstrip("/")
    version = published.current(spark, base)
    if version is None:
        raise FileNotFoundError(f"no gold tables are published in {gold_dir}")
    return spark.read.parquet(f"{base}/{version}/{name}.parquet")


def sync_to_object_store(tables: dict[str, DataFrame], names: list[str], base: str | None) -> int:
    """Copy exported tables under an object-store base path (``s3a://bucket/prefix``), as a
    version with a pointer, too.

    No base configured or nothing to copy -> 0; otherwise the number of
    tables written.  Spark writes straight to the store: no local staging.
    """
    return len(export(tables, names, base)) if base and names else 0


def list_marts(tables: dict[str, DataFrame]) -> list[str]:
    return sorted(n for n in tables if n.startswith("mart_"))
