"""Surrogate keys equal to ``row_number() OVER (ORDER BY key)`` without a
single-partition sort.

The distinct keys are range-partitioned by Spark, sorted inside their
partition and written once together with a number that holds the partition
and the place in it.  Counts per partition (one row per partition) shift each
partition by the number of keys in all earlier ones.  There is one path for
every size, and no key ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlake.session import materialize


def in_order(df: DataFrame, by: list, name: str) -> DataFrame:
    """``df`` range-partitioned and sorted by ``by``, written once, with its partition ``__b``
    and its place ``__i`` (from 0) in it; partitions follow the order."""
    out = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id())
    out = materialize(out, name)
    # Upper 31 bits: the partition, lower 33 bits: the place in it.
    return (out.withColumn("__b", F.shiftright("__at", 33))
               .withColumn("__i", F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__at"))


def offsets(placed: DataFrame, n: Column) -> DataFrame:
    """(__p, __off): the sum of ``n`` over all earlier partitions of ``in_order``'s rows.  One row
    per partition: bounded by the shuffle partitions, and broadcast."""
    sizes = placed.groupBy("__b").agg(n.alias("__n"))
    return sizes.select(F.col("__b").alias("__p"), F.coalesce(F.sum("__n").over(
        Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__off"))


def surrogate_key(df: DataFrame, key: str, name: str, *, non_null: bool = True) -> DataFrame:
    """Distinct values of ``key`` with ``name`` = 1..N in ascending key order (bigint)."""
    keys = df.select(key)
    if non_null:
        keys = keys.where(F.col(key).isNotNull())
    placed = in_order(keys.distinct(), [F.col(key).asc_nulls_first()], "surrogate-key")
    return (placed.join(F.broadcast(offsets(placed, F.count(F.lit(1)))), F.col("__b") == F.col("__p"))
                  .select((F.col("__off") + F.col("__i") + 1).cast("bigint").alias(name), key))
