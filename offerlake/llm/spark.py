"""Small session helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import offerlake.llm
from offerlake.session import materialize, table_path  # noqa: F401  (re-exported)

# Executors get this folder's functions with the task, so they need no installed copy.
cloudpickle.register_pickle_by_value(offerlake.llm)

BATCH_ROWS = 512              # rows of one Arrow batch: bounds a Python worker's memory
BROADCAST_BYTES = 32 << 20    # a side is broadcast only if its measured size is below this


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def arrow_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches small: texts can be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stored(df: DataFrame) -> int:
    """Bytes that Spark knows a stored table to have."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def small(df: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """``df`` with a broadcast hint if the stored table that bounds it (``of``, or ``df``
    itself) is small; else as it is, for a shuffled join that Spark can split."""
    return F.broadcast(df) if 4 * stored(df if of is None else of) <= BROADCAST_BYTES else df


def ids(df: DataFrame, col: str, how: str, other: DataFrame, key: str, rows: int, row_bytes: int = 24) -> DataFrame:
    """Join ``df`` with a table of ``rows`` ids.  The ids are broadcast only if
    their counted size stays under BROADCAST_BYTES; otherwise both sides are
    shuffled by the id and Spark splits skewed keys."""
    small = rows * row_bytes <= BROADCAST_BYTES
    other = other.withColumnRenamed(key, "__key")
    out = df.join(F.broadcast(other) if small else other, df[col].eqNullSafe(F.col("__key")), how)
    return out.drop("__key") if how in ("inner", "left") else out
