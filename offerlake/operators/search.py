"""Read-side operators: filtered offer search and named mart reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.sources import sinks

SEARCH_COLUMNS = ["source", "title", "company", "city", "departement", "contract", "remote",
                  "sal_min_eur", "sal_max_eur", "has_salary", "url"]
MAX_LIMIT = 500


def search_offers(fact: DataFrame, *, departement: str | None = None, contract: str | None = None,
                  has_salary: bool | None = None, limit: int = 50, order_by: str = "offer_id",
                  columns: list[str] | None = None) -> DataFrame:
    """Optional equality predicates, a fixed projection and a bounded limit.

    Predicates are plain filters, so they reach the Parquet scan; ordering by
    a unique key makes the limited page deterministic (top-k, no full sort).
    """
    if not 1 <= int(limit) <= MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{MAX_LIMIT}")
    df = fact
    if departement:
        df = df.where(F.col("departement") == departement)
    if contract:
        df = df.where(F.col("contract") == contract)
    if has_salary is not None:
        df = df.where(F.col("has_salary") == F.lit(bool(has_salary)))
    cols = columns or SEARCH_COLUMNS
    return df.orderBy(order_by).limit(int(limit)).select(*cols)


def read_mart(spark: SparkSession, name: str, catalog: dict[str, str]) -> DataFrame:
    """Scan a mart by name, only if the name is one of the known marts."""
    if name not in catalog:
        raise KeyError(f"unknown mart: {name}")
    return spark.read.parquet(catalog[name])


def register_gold(spark: SparkSession, gold_dir: str, names: list[str]) -> list[str]:
    """Expose exported gold tables as session views named after the tables."""
    for n in names:
        sinks.gold_table(spark, gold_dir, n).createOrReplaceTempView(n)
    return names


def list_marts(spark: SparkSession) -> list[str]:
    """Names of the registered marts (``mart_*``), sorted."""
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith("mart_"))


def read_registered_mart(spark: SparkSession, name: str) -> DataFrame:
    """Scan a registered mart, only if ``name`` is one of them (no SQL built from input)."""
    if name not in list_marts(spark):
        raise KeyError(f"unknown mart: {name}")
    return spark.table(name)


def query(spark: SparkSession, sql: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Parameterised read query: values bind as named parameters (``:name``),
    DataFrames as ``{name}`` placeholders; no value is spliced into the text."""
    return spark.sql(sql, args=params or {}, **frames)
