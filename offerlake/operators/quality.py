"""Data-quality checks as DataFrames: failing rows or violation counts.

Each check returns rows only when something is wrong, so "passed" means
"empty".  ``check_report`` runs a list of checks and returns one row per
check with its failure count.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def unique(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """Key values that occur more than once (null keys skipped)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    base = df
    for c in cols:
        base = base.where(F.col(c).isNotNull())
    return base.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose non-null value is outside the accepted list."""
    return df.where(F.col(col).isNotNull() & ~F.col(col).isin(list(values)))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent (anti-join)."""
    keys = parent.select(F.col(pk).alias("__pk")).distinct()
    return (child.where(F.col(fk).isNotNull())
                 .join(keys, F.col(fk) == F.col("__pk"), "left_anti"))


@dataclass
class Check:
    name: str
    failing: Callable[[], DataFrame]
    severity: str = "error"
    tags: tuple[str, ...] = field(default_factory=tuple)


def check_report(checks: Sequence[Check], *, exclude_tags: Sequence[str] = ()) -> DataFrame:
    """(check, severity, failures) for every selected check."""
    selected = [c for c in checks if not set(c.tags) & set(exclude_tags)]
    parts = [c.failing().agg(F.count(F.lit(1)).alias("failures"))
             .select(F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"), "failures")
             for c in selected]
    if not parts:
        raise ValueError("no check is selected")
    return functools.reduce(DataFrame.unionByName, parts)


def column_rules(df: DataFrame, rules: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """(rule, field, violations) for row-level conditions, in one scan.

    ``rules`` are (rule, field, violating-condition) triples.
    """
    wide = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"__v{i}")
                    for i, (_, _, cond) in enumerate(rules)])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(f).alias("field"), F.col(f"__v{i}").alias("violations"))
                     for i, (r, f, _) in enumerate(rules)])
    return wide.select(F.inline(rows))


_TYPES = {
    "string": T.StringType, "boolean": T.BooleanType, "integer": T.IntegerType,
    "bigint": T.LongType, "double": T.DoubleType, "date": T.DateType,
}


def contract_rules(df: DataFrame, contract: Sequence[dict]) -> tuple[list[tuple], list[tuple[str, str, Column]], list[str]]:
    """A contract's schema violations (rule, field, 1) in ``df``, its row rules (rule, field,
    condition of a violation) and its unique fields."""
    present = {f.name: f.dataType for f in df.schema.fields}
    schema_rows = []
    rules: list[tuple[str, str, Column]] = []
    uniques: list[str] = []
    for spec in contract:
        name, typ = spec["field"], spec.get("type")
        if name not in present:
            schema_rows.append(("missing", name, 1))
            continue
        if typ is not None and typ not in _TYPES and typ != "list<string>":
            raise ValueError(f"unknown type in the contract: {typ}")
        if typ in _TYPES and not isinstance(present[name], _TYPES[typ]):
            schema_rows.append(("type", name, 1))
        if typ == "list<string>" and not isinstance(present[name], T.ArrayType):
            schema_rows.append(("type", name, 1))
        if not spec.get("nullable", True):
            rules.append(("not_null", name, F.col(name).isNull()))
        if spec.get("enum"):
            rules.append(("enum", name, F.col(name).isNotNull() & ~F.col(name).isin(list(spec["enum"]))))
        if spec.get("max_of") and spec["max_of"] in present:
            rules.append(("min_le_max", name, F.col(name) > F.col(spec["max_of"])))
        if spec.get("unique"):
            uniques.append(name)
    return schema_rows, rules, uniques


def contract_violations(df: DataFrame, contract: Sequence[dict]) -> DataFrame:
    """Violations of a data contract: schema (presence, type) and data rules.

    ``contract`` lists fields as dicts with ``field``, ``type``, ``nullable``,
    optional ``unique``, ``enum``, ``max_of`` (this field must not exceed the
    named one).  Returns (rule, field, violations) rows with violations > 0.
    """
    spark = df.sparkSession
    schema_rows, rules, uniques = contract_rules(df, contract)
    out = spark.createDataFrame(schema_rows, "rule string, field string, violations bigint")
    if rules:
        out = out.unionByName(column_rules(df, rules))
    for u in uniques:
        dup = unique(df, u).agg(F.coalesce(F.sum(F.col("n_records") - 1), F.lit(0)).cast("bigint").alias("violations"))
        out = out.unionByName(dup.select(F.lit("unique").alias("rule"), F.lit(u).alias("field"), "violations"))
    return out.where(F.col("violations") > 0)
