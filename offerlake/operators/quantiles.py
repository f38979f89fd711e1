"""Exact quantiles that never hold a whole group in one task.

``percentile`` merges, per group, a map with one entry per distinct value in
a single task.  That is fine for a bounded value domain (rounded salaries);
for an unbounded one a hot group would sit in one task.  Here Spark
range-partitions the distinct (group, value, frequency) rows; a group may span
many partitions.  Running counts inside a partition plus the counts of the
group's earlier partitions give every value its rank interval; the values at
the ranks the quantiles need are then picked and interpolated linearly
(continuous quantile, as ``quantile_cont``).  One path serves every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlake.operators.keys import in_order


def _eq(keys: Sequence[str], left: str, right: str):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return cond


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """keys + ``n`` + one double column per entry of ``probs`` (name -> p)."""
    keys = list(keys)
    freq = (df.where(F.col(value).isNotNull())
              .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__f")))
    fb = in_order(freq, [F.col(c).asc_nulls_first() for c in [*keys, value]], "quantile-freq").drop("__i")
    w = Window.partitionBy("__b", *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    # Per (partition, group) totals: at most partitions + groups rows.
    per = fb.groupBy("__b", *keys).agg(F.sum("__f").alias("__s"))
    gw = Window.partitionBy(*keys)
    per = (per.withColumn("__off", F.coalesce(F.sum("__s").over(
                gw.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("n", F.sum("__s").over(gw)))
    ranked = (fb.alias("a").join(per.alias("p"), _eq(["__b"] + keys, "a", "p"))
                .select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{value}").alias(value),
                        F.col("a.__f").alias("__f"), F.col("a.__b").alias("__b"),
                        F.col("p.__off").alias("__off"), F.col("p.n").alias("n")))
    ranked = ranked.withColumn("__end", F.col("__off") + F.sum("__f").over(w))
    ranked = ranked.withColumn("__start", F.col("__end") - F.col("__f"))
    # Ranks (0-based) each quantile needs: floor and ceil of (n - 1) p.
    inside = lambda r: (r >= F.col("__start")) & (r < F.col("__end"))
    pos = {name: (F.col("n") - 1) * F.lit(float(p)) for name, p in probs.items()}
    hit = F.lit(False)
    for name, ps in pos.items():
        hit = hit | inside(F.floor(ps)) | inside(F.ceil(ps))
    picked = ranked.where(hit)                          # at most 2 rows per quantile and group
    aggs = [F.first("n").alias("n")]
    for name, ps in pos.items():
        aggs.append(F.max(F.when(inside(F.floor(ps)), F.col(value))).alias(f"__lo_{name}"))
        aggs.append(F.max(F.when(inside(F.ceil(ps)), F.col(value))).alias(f"__hi_{name}"))
        aggs.append(F.first(ps - F.floor(ps)).alias(f"__fr_{name}"))
    out = picked.groupBy(*keys).agg(*aggs)
    cols = [*keys, "n"]
    for name in probs:
        lo, hi, fr = (F.col(f"__lo_{name}").cast("double"), F.col(f"__hi_{name}").cast("double"),
                      F.col(f"__fr_{name}"))
        cols.append((lo + (hi - lo) * fr).alias(name))
    return out.select(*cols)
