"""Star-schema assembly: attach surrogate keys of dimensions to a fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def spread_null_key(key: Column, row_id: Column) -> Column:
    """Join key that equals ``key`` when set and, when null, a per-row value
    that no dimension row carries.

    Null keys never match, but in a shuffled join they would all hash to the
    same partition (one task for, say, every offer without a profession).
    Spreading them by a deterministic hash of the row keeps the partitions
    even and stays stable if a task is recomputed.
    """
    return F.coalesce(key.cast("string"),
                      F.concat(F.lit("\u0000"), F.xxhash64(row_id).cast("string")))


def attach_keys(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]], *,
                row_id: str | None = None) -> DataFrame:
    """Left-join each ``(dim, natural_key, surrogate_key)`` on its natural key.

    A null natural key gets a null surrogate key.  No broadcast hint is
    forced: with adaptive execution Spark measures each dimension after it is
    built and broadcasts it only under ``spark.sql.autoBroadcastJoinThreshold``
    (a checked size); a dimension that outgrows it (companies, places at
    scale) is joined with a shuffle instead, where ``row_id`` (a unique
    column of the fact) spreads rows with a null natural key.
    """
    out = fact
    for dim, nat, sk in dims:
        d = dim.select(F.col(nat).cast("string").alias("__dk"), sk)
        if row_id is None:
            out = out.join(d, F.col(nat).cast("string") == F.col("__dk"), "left")
        else:
            jk = spread_null_key(F.col(nat), F.col(row_id))
            out = (out.withColumn("__fk", jk)
                      .join(d, (F.col("__fk") == F.col("__dk")) & F.col(nat).isNotNull(), "left")
                      .drop("__fk"))
        out = out.drop("__dk")
    return out
