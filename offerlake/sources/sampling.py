"""Redacted samples of feeds that keep their container shape.

The first ``n`` records of a feed, by position, become documents of the same shape as the
feed's: an array of records, an object of records by key, or a twin map under ``byUrl``.  A
document holds ``per_doc`` consecutive records at most, so no task gets a whole sample; the
documents' names are in the order of the positions, and reading the folder gives the
sample's records in order.  Contacts are redacted in all nested string values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlake.functions.text import redact_json

# Records of each feed's sample.
RECORDS = {"wttj": 250, "indeed": 400, "cross_site": 60}
PER_DOC = 10_000


def _wrap(parts: Column, shape: str) -> Column:
    members = F.array_join(parts, ",")
    if shape == "array":
        return F.concat(F.lit("["), members, F.lit("]"))
    body = F.concat(F.lit("{"), members, F.lit("}"))
    return F.concat(F.lit('{"byUrl":'), body, F.lit("}")) if shape == "twins" else body


def sample(rows: DataFrame, n: int) -> DataFrame:
    """(pos, key, raw) of the records before position ``n``, redacted."""
    return rows.where(F.col("pos") < n).select("pos", "key", redact_json(F.col("raw")).alias("raw"))


def write_sample(rows: DataFrame, n: int, path: str, shape: str, per_doc: int = PER_DOC) -> None:
    """Write the sample of (pos, key, raw) rows as documents of ``shape``: 'array', 'object' or
    'twins'.  Records without a key get their position as key in an object, keys are not
    written in an array.  An empty sample is one empty document."""
    if shape not in ("array", "object", "twins"):
        raise ValueError(f"unknown container shape: {shape}")
    key = F.to_json(F.array(F.coalesce("key", F.col("pos").cast("string"))))
    member = F.col("raw") if shape == "array" else F.concat(F.substring(key, F.lit(2), F.length(key) - 2), F.lit(":"), F.col("raw"))
    rows = sample(rows, n)
    doc = F.lpad(F.floor(F.col("pos") / per_doc).cast("string"), 12, "0").alias("doc")
    docs = rows.select(doc, F.struct("pos", member.alias("member")).alias("r")).groupBy("doc").agg(F.sort_array(F.collect_list("r")).alias("rs"))
    none = rows.sparkSession.range(1).select(F.lpad(F.lit("0"), 12, "0").alias("doc"), F.array().cast("array<struct<pos:bigint,member:string>>").alias("rs"))
    docs = docs.unionByName(none).groupBy("doc").agg(F.flatten(F.collect_list("rs")).alias("rs"))
    (docs.select("doc", _wrap(F.col("rs.member"), shape).alias("value")).repartition("doc")
         .write.mode("errorifexists").partitionBy("doc").text(path))
