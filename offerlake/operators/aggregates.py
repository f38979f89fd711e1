"""Group counts, distributions, completeness scorecards, KPI cards.

Every operator is a single declarative plan: partial (map-side) aggregation
before the shuffle, no per-group collection, no driver loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.session import materialize


def pct(part: Column, total: Column, digits: int = 1) -> Column:
    """round(100 * part / total, digits) as double; null when total is 0."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), total.cast("double")), digits)


def count_by(df: DataFrame, keys: Sequence[str] | str, *, rename: dict[str, str] | None = None,
             non_null: Sequence[str] = (), exclude: dict[str, Sequence[str]] | None = None,
             order: bool = True, n: str = "n") -> DataFrame:
    """``SELECT keys, count(*) AS n ... GROUP BY keys ORDER BY n DESC, keys``.

    ``non_null`` drops rows whose listed columns are null before grouping;
    ``exclude`` drops listed values (``NOT IN``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    for c in non_null:
        df = df.where(F.col(c).isNotNull())
    for c, vals in (exclude or {}).items():
        df = df.where(~F.col(c).isin(list(vals)))
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    for old, new in (rename or {}).items():
        out = out.withColumnRenamed(old, new)
    if order:
        out = out.orderBy(F.desc(n), *[F.col((rename or {}).get(k, k)).asc_nulls_first() for k in keys])
    return out


def grouped_counts(df: DataFrame, sets: dict[str, Sequence[str]], *, n: str = "n") -> dict[str, DataFrame]:
    """Row counts by several sets of keys in one scan and one shuffle (grouping sets), written
    once; per name the (keys, n) of its set.  A null key is a group of its own: sets are told
    apart by the grouping id, not by nulls."""
    keys = list(dict.fromkeys(k for s in sets.values() for k in s))
    counts = df.groupingSets([[F.col(k) for k in s] for s in sets.values()], *[F.col(k) for k in keys]).agg(
        F.grouping_id(*keys).alias("__set"), F.count(F.lit(1)).alias(n))
    counts = materialize(counts, "grouped-counts")
    # A bit of the id is set for every key that is not in the set, the first key's highest.
    ident = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in s) for name, s in sets.items()}
    return {name: counts.where(F.col("__set") == ident[name]).select(*s, n) for name, s in sets.items()}


def ranked(counts: DataFrame, *, n: str = "n", **rename: str) -> DataFrame:
    """Counted groups, most frequent first, ties by key; ``rename`` gives keys new names."""
    keys = [c for c in counts.columns if c != n]
    return counts.orderBy(F.desc(n), *[F.col(k).asc_nulls_first() for k in keys]).withColumnsRenamed(rename)


def top_k(df: DataFrame, key: str, k: int, *, n: str = "n", extra: Sequence[Column] = ()) -> DataFrame:
    """The ``k`` most frequent values of ``key``; ties broken by the key value."""
    agg = df.groupBy(key).agg(*extra, F.count(F.lit(1)).alias(n))
    return agg.orderBy(F.desc(n), F.col(key).asc_nulls_first()).limit(k)


def distribution(df: DataFrame, key: str, value: str, *, min_n: int = 1, extremes: bool = True,
                 out_key: str | None = None, bounded_domain: bool = False) -> DataFrame:
    """Box-plot per group: n, median, q1, q3 (and min, max), all rounded.

    Exact continuous quantiles.  By default they come from
    ``quantiles.exact_quantiles``, where no task holds a whole group.  With
    ``bounded_domain`` (the value takes few distinct values, e.g. rounded
    salaries in a fixed band) rows are reduced to (group, value, frequency)
    and ``percentile`` merges one entry per distinct value per group.
    """
    from offerlake.operators.quantiles import exact_quantiles

    out_key = out_key or key
    v = F.col(value)
    if bounded_domain:
        freq = (df.where(v.isNotNull()).groupBy(key, value).agg(F.count(F.lit(1)).alias("__f")))
        f = F.col("__f")
        aggs = [
            F.sum(f).alias("n"),
            F.round(F.percentile(v, 0.5, f), 0).alias("median"),
            F.round(F.percentile(v, 0.25, f), 0).alias("q1"),
            F.round(F.percentile(v, 0.75, f), 0).alias("q3"),
        ]
        if extremes:
            aggs += [F.round(F.min(v).cast("double"), 0).alias("mini"),
                     F.round(F.max(v).cast("double"), 0).alias("maxi")]
        out = freq.groupBy(key).agg(*aggs).where(F.col("n") >= min_n)
    else:
        probs = {"median": 0.5, "q1": 0.25, "q3": 0.75}
        if extremes:
            probs.update({"mini": 0.0, "maxi": 1.0})
        q = exact_quantiles(df, [key], value, probs).where(F.col("n") >= min_n)
        out = q.select(key, "n", *[F.round(F.col(c), 0).alias(c) for c in probs])
    if out_key != key:
        out = out.withColumnRenamed(key, out_key)
    return out.orderBy(F.desc("median"), F.col(out_key).asc_nulls_first())


def completeness(df: DataFrame, fields: Sequence[tuple[str, Column]], *,
                 label: str = "champ") -> DataFrame:
    """Scorecard (label, rempli, total, pct) for boolean conditions, one scan.

    All counts come from one aggregate; the wide row is then unpivoted with
    ``stack`` instead of one scan per field.
    """
    wide = df.agg(F.count(F.lit(1)).alias("__total"),
                  *[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"__c{i}")
                    for i, (_, cond) in enumerate(fields)])
    args = ", ".join(f"'{_sql_str(name)}', __c{i}" for i, (name, _) in enumerate(fields))
    long = wide.selectExpr(f"stack({len(fields)}, {args}) AS ({label}, rempli)", "__total AS total")
    return (long.withColumn("pct", pct(F.col("rempli"), F.col("total")))
                .orderBy(F.desc("pct"), F.col(label)))


def frozen_counts(df: DataFrame, checks: Sequence[tuple[str, Column, int]], *,
                  mismatches_only: bool = True) -> DataFrame:
    """(verif, obtenu, attendu) for counted conditions against expectations.

    One conditional aggregate for all checks, then ``stack``; by default only
    the rows where the count differs from the expectation are returned.
    """
    wide = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"__c{i}")
                    for i, (_, cond, _) in enumerate(checks)])
    args = ", ".join(f"'{_sql_str(name)}', __c{i}, CAST({int(exp)} AS BIGINT)"
                     for i, (name, _, exp) in enumerate(checks))
    long = wide.selectExpr(f"stack({len(checks)}, {args}) AS (verif, obtenu, attendu)")
    return long.where(F.col("obtenu") != F.col("attendu")) if mismatches_only else long


def _sql_str(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")


def side_by_side(*rows: DataFrame) -> DataFrame:
    """Combine one-row results into one row (distinct column names).

    A union followed by one aggregate: no join, so no cross product in the
    plan.  Each input must have exactly one row.
    """
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    cols = [c for r in rows for c in r.columns]
    return out.agg(*[F.first(c, ignorenulls=True).alias(c) for c in cols])
