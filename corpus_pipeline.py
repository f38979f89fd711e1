"""The corpus pipeline: toxicity, line dedup, near-duplicates, mixing, pieces.

Every stage takes the whole output of the one before; all but the last return the columns
of ``documents`` (others that the input has are carried along).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlake.llm import line_dedup as lines
from offerlake.llm import minhash_dedup, mixing, pieces, toxicity
from offerlake.llm.spark import materialize, read
from offerlake.session import scratch_path

#: A classifier and a shuffled mix are no SQL: tests/llm/test_pipeline.py holds the stages
#: and run() against small fixtures instead.
ORACLE_SQL = None


def _rows(docs: DataFrame, name: str) -> DataFrame:
    """row (the whole input row, whatever its columns are called), number (its own), doc_id, text
    and source, written once."""
    source = F.col("source") if "source" in docs.columns else F.lit(None).cast("string")
    return materialize(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number"), "doc_id", "text", source.alias("source")), name)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the field predicts as toxic go.  A doc_id with several texts goes text by text."""
    field = toxicity.train(docs, read(spark, sf_dir, "labels"))
    keyed = docs.select(F.struct("*").alias("row"), F.struct("doc_id", F.xxhash64("text").alias("h")).alias("doc_id"), "text")
    judged = toxicity.score(keyed.select("doc_id", "text"), field)
    toxic = judged.where("predicted = 1").select(F.col("doc_id.doc_id").alias("t_id"), F.col("doc_id.h").alias("t_h")).distinct()
    return (keyed.join(toxic, keyed["doc_id.doc_id"].eqNullSafe(F.col("t_id")) & keyed["doc_id.h"].eqNullSafe(F.col("t_h")), "left_anti")
                 .select("row.*"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every text keeps the first occurrence of its lines only; documents stay."""
    out = lines.dedup_lines(docs)
    cols = [F.col("text") if c == "text" else F.length("text").cast("bigint").alias(c) if c == "n_chars" else F.col("row").getField(c).alias(c)
            for c in docs.columns]
    return out.select(*cols)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays: the first by doc_id (null last), text
    hash and row number.  Rows are told apart by their own number, so rows that repeat a
    doc_id, or have none, are judged one by one."""
    rows = _rows(docs, "pipeline-near")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", F.xxhash64("text").alias("h"), F.col("number").alias("row"))
    judged = minhash_dedup.near_duplicates(rows.select(order.alias("doc_id"), "text"))
    gone = judged.where("not kept").select(F.col("doc_id.row").alias("number"))
    return rows.join(gone, "number", "left_anti").select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, in whole passes.  The mix takes a source's
    documents one after another, so at most one of a source is taken in part; that one is
    rounded, and a source's words differ from its target by half its longest document at most
    (besides the target's own rounding)."""
    rows = _rows(docs, "pipeline-mix")
    taken = mixing.taken(rows.select("number", "text", "source"), id_col="number")
    taken = taken.select(F.col("doc_id").alias("taken"), F.expr("cast(round(coalesce(try_divide(taken, size), 0)) as int)").alias("passes"))
    return (rows.join(taken.where("passes > 0"), F.col("number") == F.col("taken"))
                .withColumn("pass", F.explode(F.sequence(F.lit(1), "passes"))).select("row.*"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_units, n_pieces, ids and round_trip of every document."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}-{uuid.uuid4().hex[:12]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
